"""Plates that were exposed several times: the pattern of a star's images, and the exposure that each detection belongs to.

All plates go through one chain of joins and aggregations. The brightest detections of a plate are clustered in place and
magnitude; clusters of as many members as there were exposures are the images of one star. Members are taken relative to their
cluster's centre; against the cluster nearest to the middle of the image each one has a scale and a rotation, to which a
plane over the plate is fitted. With these taken out, the members of all clusters fall on the exposures' places, which are
clustered once more. Every detection is then tried as the first image of a star: where each place of the pattern, turned and
scaled as the planes say, has a detection, these get the exposures' numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.operators import fits
from skyledger.operators.crossmatch import grid_pairs

#: Fixed values of the method: pixels between an exposure's place and a member, members that make a place, accepted clusters
#: at least and those from which scale and rotation are fitted, pixels between a place and its detection, patterns at least.
PLACE_RADIUS, PLACE_LEAST, CLUSTERS_LEAST, CLUSTERS_FITTED, MATCH_RADIUS, PATTERNS_LEAST = 5.0, 4, 5, 10, 10.0, 10
#: Width of a cell in match radii: few detections lie in one, and few are repeated for its neighbours.
MATCH_SPAN = 10.0


def _by_exposures(few: float, some: float, many: float) -> Column:
    """A value for up to 10 exposures, up to 20, and more."""
    return F.when(F.col("numexp") > 20, many).when(F.col("numexp") > 10, some).otherwise(few)


def selected(sources: DataFrame, plates: DataFrame) -> DataFrame:
    """The brightest detections of each plate that are clustered, with their number by brightness (ties by id).

    sources: plate, id, x, y, mag; plates: plate, numexp, dist_peak (the most frequent distance of neighbours), width, height."""
    known = fits._shuffled(sources.where("x IS NOT NULL AND y IS NOT NULL AND mag IS NOT NULL"), plates, ["plate"])
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("plate").orderBy("mag", "id")))
    return ranked.where(F.col("rank") <= _by_exposures(200, 100, 50) * F.col("numexp"))


def star_clusters(sources: DataFrame, plates: DataFrame, depth: float = 10.0) -> DataFrame:
    """Members of clusters of as many detections as exposures (within a tenth): plate, id, x, y, label, numexp, width, height, accepted.

    Two magnitudes are as far apart as `depth` times the peak distance for each unit. Plates with fewer than CLUSTERS_LEAST
    such clusters have none."""
    rows = selected(sources, plates)
    reach = _by_exposures(4, 3, 2) * F.col("dist_peak")
    rows = rows.withColumns({"_u": F.col("x") / reach, "_v": F.col("y") / reach, "_w": F.col("mag") * F.col("dist_peak") * depth / reach, "least": _by_exposures(4, 2, 1).cast("int")})
    labelled_rows = fits.clusters_each(rows, "plate", "id", {"_u": 1.0, "_v": 1.0, "_w": 1.0}, "least")
    members = labelled_rows.select("plate", "id", "x", "y", "label", "numexp", "width", "height").repartition("plate")
    own = Window.partitionBy("plate", "label")
    sized = members.withColumn("_size", F.count(F.lit(1)).over(own)).where(F.abs(F.col("_size") - F.col("numexp")) < 0.1 * F.col("numexp"))
    # A label is the id of one of its cluster's members.
    counted = sized.withColumn("accepted", F.count(F.when(F.col("id") == F.col("label"), 1)).over(Window.partitionBy("plate")))
    return counted.where(F.col("accepted") >= CLUSTERS_LEAST).drop("_size")


def regular_clusters(members: DataFrame) -> DataFrame:
    """`members` relative to their cluster's centre (cx, cy; lx, ly), without clusters whose least or greatest distance to the
    nearest other member lies beyond the plate's fences of 1.5 quartile ranges.

    Windows over a plate and its clusters, so that rows dealt by plate stay where they are; a cluster has about as many members as there are exposures."""
    own, plate = Window.partitionBy("plate", "label"), Window.partitionBy("plate")
    others = F.filter("_all", lambda o: o["id"] != F.col("id"))
    nearest = F.array_min(F.transform(others, lambda o: F.hypot(F.col("x") - o["x"], F.col("y") - o["y"])))
    rows = members.withColumn("_all", F.collect_list(F.struct("id", "x", "y")).over(own)).withColumn("_d", nearest).drop("_all")
    rows = rows.withColumns({"_near": F.min("_d").over(own), "_far": F.max("_d").over(own), "_one": F.min("id").over(own)})
    quartiles = lambda c: F.percentile(F.when(F.col("id") == F.col("_one"), F.col(c)), F.array(F.lit(0.25), F.lit(0.75))).over(plate)
    rows = rows.withColumns({"_nears": quartiles("_near"), "_fars": quartiles("_far")})

    def inside(c: str) -> Column:
        low, high = F.col(f"{c}s")[0], F.col(f"{c}s")[1]
        return F.col(c).between(low - 1.5 * (high - low), high + 1.5 * (high - low))

    kept = rows.where(inside("_near") & inside("_far"))
    middle = lambda c: (F.min(c).over(own) + F.max(c).over(own)) / 2
    placed = kept.withColumns({"cx": middle("x"), "cy": middle("y")}).withColumns({"lx": F.col("x") - F.col("cx"), "ly": F.col("y") - F.col("cy")})
    return placed.drop("_d", "_near", "_far", "_one", "_nears", "_fars")


PLANES = ("scale_x", "scale_y", "scale_0", "angle_x", "angle_y", "angle_0")


def planes(members: DataFrame) -> DataFrame:
    """For each plate the planes of scale and rotation (degrees) over x and y, against the cluster nearest to the image's middle;
    scale 1 and rotation 0 where there are few clusters or many exposures. members: of regular_clusters."""
    off = F.hypot(F.col("cx") - (F.col("width") + 1) / 2, F.col("cy") - (F.col("height") + 1) / 2)
    plate = Window.partitionBy("plate")
    rows = members.withColumn("_middle", F.min(F.struct(off.alias("off"), "label")).over(plate)["label"])
    mark = F.when(F.col("label") == F.col("_middle"), F.struct(F.col("id").alias("rid"), F.col("lx").alias("rx"), F.col("ly").alias("ry")))
    rows = rows.withColumn("_marks", F.collect_list(mark).over(plate)).where((F.col("accepted") > CLUSTERS_FITTED) & (F.col("numexp") < 10))
    near = F.array_min(F.transform("_marks", lambda r: F.struct(F.hypot(F.col("lx") - r["rx"], F.col("ly") - r["ry"]).alias("d"), r["rid"].alias("rid"), r["rx"].alias("rx"), r["ry"].alias("ry"))))
    matched = rows.withColumn("r", near).select("plate", "label", "cx", "cy", "lx", "ly", F.col("r.rx").alias("rx"), F.col("r.ry").alias("ry"))
    found = fits.scale_rotation(matched, ["plate", "label", "cx", "cy"], "rx", "ry", "lx", "ly")
    turn = F.when(F.col("rotation") > 90, F.col("rotation") - 180).when(F.col("rotation") < -90, F.col("rotation") + 180).otherwise(F.col("rotation"))
    found = found.withColumn("rotation", turn).where("scale IS NOT NULL")
    name = lambda kind: {"a": f"{kind}_x", "b": f"{kind}_y", "c": f"{kind}_0"}
    scale = fits.plane(found, ["plate"], "cx", "cy", "scale").select("plate", "a", "b", "c").withColumnsRenamed(name("scale"))
    angle = fits.plane(found.where("abs(rotation) < 10"), ["plate"], "cx", "cy", "rotation").select("plate", "a", "b", "c").withColumnsRenamed(name("angle"))
    every = members.select("plate").distinct().join(scale, "plate", "left").join(angle, "plate", "left")
    return every.withColumns({c: F.coalesce(c, F.lit(1.0 if c == "scale_0" else 0.0)) for c in PLANES})


def _at(kind: str, x: str, y: str) -> Column:
    return F.col(f"{kind}_x") * F.col(x) + F.col(f"{kind}_y") * F.col(y) + F.col(f"{kind}_0")


def exposure_places(members: DataFrame, found: DataFrame) -> DataFrame:
    """The pattern of each plate: plate, exposure_num (from 1), dx, dy, num_exposures. Places are numbered along the axis on which they
    spread wider (x if equally), and the first one is the origin. members: of regular_clusters; found: of planes."""
    angle, scale = F.radians(_at("angle", "cx", "cy")), _at("scale", "cx", "cy")
    x, y = F.col("lx"), F.col("ly")
    plain = fits._shuffled(members, found, ["plate"]).select("plate", "id", ((x * F.cos(angle) + y * F.sin(angle)) / scale).alias("px"), ((y * F.cos(angle) - x * F.sin(angle)) / scale).alias("py"), F.lit(PLACE_LEAST).alias("least"))
    labels = fits.clusters_each(plain, "plate", "id", {"px": PLACE_RADIUS, "py": PLACE_RADIUS}, "least")
    places = labels.groupBy("plate", "label").agg(F.avg("px").alias("px"), F.avg("py").alias("py"))
    own = Window.partitionBy("plate")
    upright = F.max("py").over(own) - F.min("py").over(own) > F.max("px").over(own) - F.min("px").over(own)
    along = F.when(F.col("upright"), F.col("py")).otherwise(F.col("px"))
    order = Window.partitionBy("plate").orderBy("along", "px", "py")
    numbered = places.withColumn("upright", upright).withColumn("along", along).withColumns({"exposure_num": F.row_number().over(order), "num_exposures": F.count(F.lit(1)).over(own)})
    return numbered.select("plate", "exposure_num", *((F.col(c) - F.first(c).over(order)).alias(d) for c, d in (("px", "dx"), ("py", "dy"))), "num_exposures")


def labelled(sources: DataFrame, pattern: DataFrame, found: DataFrame) -> DataFrame:
    """`sources` with exposure_num: that of the pattern in which a detection was found, 0 where it was in none or its plate has
    fewer than PATTERNS_LEAST patterns.

    A pattern is found at a detection if each place has another (or itself) nearer than MATCH_RADIUS. Of several patterns
    that hold a detection the one at the faintest first image counts (of equal magnitudes that of the greatest id)."""
    known = sources.where("x IS NOT NULL AND y IS NOT NULL AND mag IS NOT NULL")
    angle, scale = F.radians(_at("angle", "x", "y")), _at("scale", "x", "y")

    def hits(firsts: DataFrame, tried: DataFrame) -> DataFrame:
        at = fits._shuffled(fits._shuffled(firsts, found, ["plate"]), tried, ["plate"])
        places = at.select(
            "plate", F.struct("id", "exposure_num", "num_exposures", "mag", "plate").alias("place"),
            (F.col("x") + scale * (F.col("dx") * F.cos(angle) - F.col("dy") * F.sin(angle))).alias("x"), (F.col("y") + scale * (F.col("dx") * F.sin(angle) + F.col("dy") * F.cos(angle))).alias("y"),
        )
        return grid_pairs(places, known, "place", "id", {"x": MATCH_RADIUS, "y": MATCH_RADIUS}, ["plate"], MATCH_SPAN).where("dist < 1")

    # The last place is tried first, at every detection; the whole pattern only where that one has a detection.
    likely = hits(known, pattern.where("exposure_num = num_exposures")).select("left_id.id").distinct()
    near = hits(fits._shuffled(known, likely, ["id"], "left_semi"), pattern).select("left_id.*", "dist", "right_id").repartition("id")
    nearest = near.groupBy("id", "exposure_num", "num_exposures", "mag", "plate").agg(F.min(F.struct("dist", "right_id")).alias("n")).withColumn("hit", F.col("n.right_id"))
    all_of = fits.checkpointed(nearest.drop("n").withColumn("matched", F.count(F.lit(1)).over(Window.partitionBy("id"))).where(F.col("matched") == F.col("num_exposures")))
    enough = all_of.where("exposure_num = 1").groupBy("plate").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PATTERNS_LEAST).select("plate")
    label = fits._shuffled(all_of, enough, ["plate"], "left_semi").groupBy("hit").agg(F.max_by("exposure_num", F.struct("mag", "id", "exposure_num")).alias("exposure_num"))
    return fits._shuffled(sources, label.withColumnRenamed("hit", "id"), ["id"], "left").withColumn("exposure_num", F.coalesce("exposure_num", F.lit(0)))


def exposure_numbers(sources: DataFrame, plates: DataFrame, depth: float = 10.0) -> DataFrame:
    """The whole chain: `sources` (plate, id, x, y, mag; ids differ between plates) with exposure_num.

    plates: plate, numexp, dist_peak, width, height."""
    members = fits.checkpointed(regular_clusters(star_clusters(sources, plates, depth)))
    found = fits.checkpointed(planes(members))
    return labelled(sources, fits.checkpointed(exposure_places(members, found)), found)
