"""Queries of astrometric solutions and header edits, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions import sky
from skyledger.operators import headers, solutions
from skyledger.plans.binding import load, on_sky, separation_sql, sky_sql
from skyledger.plans.registry import query

#: A solution for each customer: positions over the sphere, turned and, every third, mirrored images.
SCALE = "(0.0004::DOUBLE * (1 + c_custkey % 7))"
TURN = "radians(CAST(c_custkey * 37 % 360 AS DOUBLE))"
FLIP = "(CASE WHEN c_custkey % 3 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)"
SOLUTIONS = f"""SELECT c_custkey, c_nationkey AS plate, 1 + c_custkey % 900 AS num_sources, 8000 AS imwidth, 6000 AS imheight, ra AS ra_icrs, dec AS dec_icrs, 4000.5::DOUBLE AS crpix1, 3000.5::DOUBLE AS crpix2,
    -{SCALE} * {FLIP} * cos({TURN}) AS cd1_1, {SCALE} * sin({TURN}) AS cd1_2, {SCALE} * {FLIP} * sin({TURN}) AS cd2_1, {SCALE} * cos({TURN}) AS cd2_2 FROM (SELECT *, {sky_sql("c_custkey")} FROM customer)"""


def plate_solutions(spark, d):
    k, c = F.col("c_custkey"), F.col
    scale, turn, flip = F.lit(0.0004) * (1 + k % 7), F.radians((k * 37 % 360).cast("double")), F.when(k % 3 == 0, -1.0).otherwise(1.0)
    return on_sky(load(spark, d, "customer"), "c_custkey").select(
        "c_custkey", c("c_nationkey").alias("plate"), (1 + k % 900).alias("num_sources"), F.lit(8000).alias("imwidth"), F.lit(6000).alias("imheight"), c("ra").alias("ra_icrs"), c("dec").alias("dec_icrs"), F.lit(4000.5).alias("crpix1"), F.lit(3000.5).alias("crpix2"), F.lit(0.75).alias("rel_area"),
        (-scale * flip * F.cos(turn)).alias("cd1_1"), (scale * F.sin(turn)).alias("cd1_2"), (scale * flip * F.sin(turn)).alias("cd2_1"), (scale * F.cos(turn)).alias("cd2_2"),
    )


#: Positions of named pixels: edge middles e0 to e3, corners k0 to k3.
PLACES = f"""WITH s AS ({SOLUTIONS}),
    p AS (SELECT s.*, name, radians(cd1_1 * (px - crpix1) + cd1_2 * (py - crpix2)) AS xi, radians(cd2_1 * (px - crpix1) + cd2_2 * (py - crpix2)) AS eta, radians(dec_icrs) AS d0
      FROM s, (VALUES ('e0', 1.0::DOUBLE, 3000.5::DOUBLE), ('e1', 8000, 3000.5), ('e2', 4000.5, 1), ('e3', 4000.5, 6000), ('k0', 1, 1), ('k1', 8000, 1), ('k2', 8000, 6000), ('k3', 1, 6000)) v(name, px, py)),
    q AS (SELECT *, ra_icrs + degrees(atan2(xi, cos(d0) - eta * sin(d0))) AS pra0, degrees(atan2(sin(d0) + eta * cos(d0), sqrt(xi * xi + pow(cos(d0) - eta * sin(d0), 2)))) AS pdec FROM p),
    r AS (SELECT *, pra0 - 360.0::DOUBLE * floor(pra0 / 360.0::DOUBLE) AS pra FROM q),
    w AS (SELECT c_custkey, any_value(plate) AS plate, any_value(num_sources) AS num_sources, any_value(ra_icrs) AS ra_icrs, any_value(dec_icrs) AS dec_icrs, any_value(cd1_1 * cd2_2 - cd1_2 * cd2_1) AS det, any_value(cd1_1) AS cd1_1, any_value(cd1_2) AS cd1_2, any_value(cd2_1) AS cd2_1, any_value(cd2_2) AS cd2_2,
      {", ".join(f"max(pra) FILTER (name = '{n}') AS {n}_ra, max(pdec) FILTER (name = '{n}') AS {n}_dec" for n in ("e0", "e1", "e2", "e3", "k0", "k1", "k2", "k3"))} FROM r GROUP BY c_custkey),
    f AS (SELECT *, {separation_sql("e0_ra", "e0_dec", "e1_ra", "e1_dec")} AS fov1, {separation_sql("e2_ra", "e2_dec", "e3_ra", "e3_dec")} AS fov2 FROM w)"""


@query(
    "solution_parameters",
    f"""{PLACES}, g AS (SELECT *, sqrt(fov1 * fov1 + fov2 * fov2) / 2 AS half_diag FROM f)
    SELECT c_custkey, round(fov1, 7) AS fov1, round(fov2, 7) AS fov2, round((fov1 / 8000 + fov2 / 6000) * 1800, 6) AS pixel_scale, round(half_diag, 7) AS half_diag, round(num_sources / (0.75 * fov1 * fov2), 3) AS source_density, 90 - dec_icrs <= half_diag AS ncp_close, 90 + dec_icrs <= half_diag AS scp_close,
    round(k0_ra, 6) AS k0_ra, round(k2_dec, 6) AS k2_dec, c_custkey % 3 = 0 AS plate_mirrored FROM g""",
)
def solution_parameters(spark, d):
    corner = lambda k, n: F.round(F.get("corners", F.lit(k))[n], 6).alias(f"k{k}_{n}")
    p = solutions.parameters(plate_solutions(spark, d))
    return p.select("c_custkey", *(F.round(x, 7).alias(x) for x in ("fov1", "fov2")), F.round("pixel_scale", 6).alias("pixel_scale"), F.round("half_diag", 7).alias("half_diag"), F.round("source_density", 3).alias("source_density"), "ncp_close", "scp_close", corner(0, "ra"), corner(2, "dec"), "plate_mirrored")


@query("solution_rotation", f"SELECT c_custkey, CASE WHEN a > 180 THEN a - 360 ELSE a END AS rotation FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 360 - c_custkey * 37 % 360 ELSE c_custkey * 37 % 360 END AS a FROM customer) WHERE a % 180 <> 0")
def solution_rotation(spark, d):
    """The angle that each image was turned by (without the ambiguous 0 and 180)."""
    p = solutions.parameters(plate_solutions(spark, d)).filter("c_custkey * 37 % 360 <> 0 AND c_custkey * 37 % 360 <> 180")
    return p.select("c_custkey", F.round("rotation_angle").cast("long").alias("rotation"))


@query(
    "solution_validity",
    f"""{PLACES} SELECT c_custkey, fov1 >= 1e-3 AND fov2 >= 1e-3 AND fov1 / fov2 / (8000 / 6000.0::DOUBLE) > 0.95 AND fov1 / fov2 / (8000 / 6000.0::DOUBLE) < 1.05 AS valid FROM f""",
)
def solution_validity(spark, d):
    return solutions.valid_solutions(plate_solutions(spark, d)).select("c_custkey", "valid")


@query("poles_on_plates", f"SELECT c_custkey, abs(dec) + 0.0004::DOUBLE * (1 + c_custkey % 7) * 3000 > 90 AND dec > 0 AS ncp, abs(dec) + 0.0004::DOUBLE * (1 + c_custkey % 7) * 3000 > 90 AND dec < 0 AS scp FROM (SELECT *, {sky_sql('c_custkey')} FROM customer) WHERE c_custkey * 37 % 180 = 0")
def poles_on_plates(spark, d):
    """Poles on images that stand upright: those whose upper or lower edge reaches beyond the pole (flat, as fields are small)."""
    p = solutions.parameters(plate_solutions(spark, d)).filter("c_custkey * 37 % 180 = 0")
    return p.select("c_custkey", F.col("ncp_on_plate").alias("ncp"), F.col("scp_on_plate").alias("scp"))


@query("solution_statistics", f"{PLACES} SELECT plate, count(*) AS num_solutions, round(avg(s), 6) AS mean_pixel_scale, round(min(s), 6) AS min_pixel_scale, round(max(s), 6) AS max_pixel_scale, round(avg(fov1), 6) AS mean_fov1, round(avg(fov2), 6) AS mean_fov2, round(avg(num_sources / (0.75 * fov1 * fov2)), 3) AS source_density FROM (SELECT *, (fov1 / 8000 + fov2 / 6000) * 1800 AS s FROM f) GROUP BY plate")
def solution_statistics(spark, d):
    s = solutions.plate_statistics(solutions.parameters(plate_solutions(spark, d)), "plate")
    return s.select("plate", "num_solutions", *(F.round(x, 6).alias(x) for x in ("mean_pixel_scale", "min_pixel_scale", "max_pixel_scale", "mean_fov1", "mean_fov2")), F.round("source_density", 3).alias("source_density"))


@query("plate_limits", "SELECT p_brand AS plate, min(p_size) AS bright_limit, max(p_size) AS faint_limit, round(avg(p_retailprice / 1000), 9) AS mean_color_term, round(sum(p_retailprice / 1000 * (p_partkey % 50)) / sum(p_partkey % 50), 9) AS color_term FROM part GROUP BY p_brand")
def plate_limits(spark, d):
    rows = load(spark, d, "part").select(F.col("p_brand").alias("plate"), F.col("p_size").alias("bright_limit"), F.col("p_size").alias("faint_limit"), (F.col("p_retailprice") / 1000).alias("color_term"), (F.col("p_partkey") % 50).alias("cterm_num_stars"))
    return solutions.plate_limits(rows, "plate").select("plate", "bright_limit", "faint_limit", F.round("mean_color_term", 9).alias("mean_color_term"), F.round("color_term", 9).alias("color_term"))


@query(
    "unique_solutions",
    """WITH m AS (SELECT o_custkey AS plate, o_orderkey, row_number() OVER w AS i, o_orderkey % 4 AS spot FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
    u AS (SELECT *, min(i) OVER (PARTITION BY plate, spot) AS first FROM m), n AS (SELECT *, count(*) FILTER (i = first) OVER (PARTITION BY plate ORDER BY i) AS uniques FROM u)
    SELECT o_orderkey, CASE WHEN n.i = n.first THEN uniques ELSE uniques - n.i END AS solution_num, CASE WHEN n.i <> n.first THEN (SELECT f.uniques FROM n f WHERE f.plate = n.plate AND f.i = n.first) END AS unique_num FROM n""",
)
def unique_solutions(spark, d):
    """Solutions at one of four spots of a plate, a pixel or so apart: the first at each spot is unique."""
    k = F.col("o_orderkey")
    rows = load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("plate"), (F.lit(10.0) + k % 4 + (k % 3) / 3600.0).alias("ra_icrs"), F.lit(20.0).alias("dec_icrs"), F.lit(1.0).alias("pixel_scale"))
    n = solutions.numbered(rows, "plate", "o_orderkey")
    return n.select("o_orderkey", F.col("solution_num").cast("long").alias("solution_num"), F.col("unique_num").cast("long").alias("unique_num"))


@query("matched_centroids", "SELECT o_orderpriority AS solution, count(*) AS num_matched, round(avg(CAST(o_orderkey * 7919 % 10000 AS DOUBLE)), 6) AS x_centroid, round(avg(CAST(o_orderkey * 104729 % 8000 AS DOUBLE)) / 8000, 9) AS rel_y_centroid FROM orders GROUP BY 1")
def matched_centroids(spark, d):
    rows = load(spark, d, "orders").select(F.col("o_orderpriority").alias("solution"), (F.col("o_orderkey") * 7919 % 10000).cast("double").alias("x_source"), (F.col("o_orderkey") * 104729 % 8000).cast("double").alias("y_source"))
    m = solutions.matched_centroids(rows, ["solution"], F.lit(10000.0), F.lit(8000.0))
    return m.select("solution", "num_matched", F.round("x_centroid", 6).alias("x_centroid"), F.round("rel_y_centroid", 9).alias("rel_y_centroid"))


@query(
    "pattern_correction",
    """WITH s AS (SELECT o_orderkey, o_orderkey % 3 AS plate, CAST(o_orderkey * 7919 % 10000 AS DOUBLE) AS x, CAST(o_orderkey * 104729 % 8000 AS DOUBLE) AS y FROM orders),
    b AS (SELECT *, floor(x / 100) AS i, floor(y / 100) AS j FROM s)
    SELECT o_orderkey, round(CASE WHEN plate = 0 THEN x - ((i % 5) / 10 + (x / 100 - i) * (((i + 1) % 5) / 10 - (i % 5) / 10)) ELSE x END, 7) AS x_source, round(CASE WHEN plate = 2 THEN y - ((j % 7) / 10 + (y / 100 - j) * (((j + 1) % 7) / 10 - (j % 7) / 10)) ELSE y END, 7) AS y_source FROM b""",
)
def pattern_correction(spark, d):
    """Saw-tooth patterns; the ratios of plates 0, 1 and 2 are 0.5, 1 and 2."""
    k = F.col("o_orderkey")
    rows = load(spark, d, "orders").select("o_orderkey", (k % 3).alias("plate"), (k * 7919 % 10000).cast("double").alias("x_source"), (k * 104729 % 8000).cast("double").alias("y_source")).withColumn("pattern_ratio", F.pow(F.lit(2.0), F.col("plate") - 1))
    at = lambda axis, n: F.struct(F.lit(axis).alias("axis"), ((F.col("id") % n) / 10).alias("value"))
    knots = spark.range(101).select("id", (F.col("id") * 100).alias("position"), F.explode(F.array(at("x", 5), at("y", 7))).alias("s"))
    knots = knots.withColumn("plate", F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))))
    p = solutions.pattern_corrected(rows, knots.select("plate", "position", "s.*"), "plate")
    return p.select("o_orderkey", F.round("x_source", 7).alias("x_source"), F.round("y_source", 7).alias("y_source"))


@query("cluster_acceptance", "WITH c AS (SELECT o_custkey % 40 AS plate, o_custkey AS cluster, count(*) AS size FROM orders GROUP BY ALL), f AS (SELECT * FROM c WHERE abs(size - 15) < 1.5) SELECT plate, cluster, size FROM f WHERE plate IN (SELECT plate FROM f GROUP BY plate HAVING count(*) >= 5)")
def cluster_acceptance(spark, d):
    c = load(spark, d, "orders").groupBy((F.col("o_custkey") % 40).alias("plate"), F.col("o_custkey").alias("cluster")).agg(F.count(F.lit(1)).alias("size")).withColumn("numexp", F.lit(15))
    return solutions.accepted_clusters(c, "plate", "size", "numexp").select("plate", "cluster", "size")


@query("cluster_compactness", "SELECT o_custkey AS cluster, count(*) AS size, round(avg(o_totalprice), 4) AS x, greatest(stddev_pop(o_totalprice), stddev_pop(o_orderkey % 1000)) <= 90000 AS compact FROM orders GROUP BY 1")
def cluster_compactness(spark, d):
    o = load(spark, d, "orders").select(F.lit(1).alias("plate"), F.col("o_custkey").alias("cluster"), F.col("o_totalprice").alias("px"), (F.col("o_orderkey") % 1000).alias("py"))
    return solutions.compact_clusters(o, ["plate"], "cluster", "px", "py", 90000.0).select("cluster", "size", F.round("x", 4).alias("x"), "compact")


@query(
    "header_value_edits",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS platesz1, CAST(p_size + 4 AS DOUBLE) AS platesz2, p_size * 60.0::DOUBLE AS exptime, 'A. B. Schmidt-' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2, 1)) || ' O''Neil' AS observer, CASE WHEN p_partkey % 3 = 2 THEN p_brand ELSE 'none' END AS filter,
    '1995-0' || (1 + p_partkey % 9) || '-10T' || lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS date_obs, CASE WHEN p_partkey % 24 < 12 THEN '1995-0' || (1 + p_partkey % 9) || '-09' ELSE '1995-0' || (1 + p_partkey % 9) || '-10' END AS date_orig FROM part""",
)
def header_value_edits(spark, d):
    k, c = F.col("p_partkey"), F.col
    p = load(spark, d, "part")
    rows = p.select("p_partkey", F.concat_ws("x", c("p_size").cast("string"), (c("p_size") + 4).cast("string")).alias("size"), c("p_size").cast("string").alias("minutes"), F.concat(F.lit("a.b.SCHMIDT-"), F.lower(F.substring("p_type", 1, 2)), F.lit(" o'neil")).alias("who"), F.when(k % 3 == 0, "NONE").when(k % 3 == 1, "NO").otherwise(c("p_brand")).alias("glass"), F.concat(F.lit("1995-0"), (1 + k % 9).cast("string"), F.lit("-10")).alias("day"), F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30:00")).alias("clock"))
    wide, high = headers.plate_sizes(c("size"))
    start = headers.joined_date(c("day"), c("clock"))
    return rows.select("p_partkey", wide.alias("platesz1"), high.alias("platesz2"), headers.seconds_of_minutes(c("minutes")).alias("exptime"), headers.named_observer(c("who")).alias("observer"), headers.plain_filter(c("glass")).alias("filter"), start.alias("date_obs"), headers.evening_date(start).alias("date_orig"))


FOOTPRINT = [(10.0, -8.0), (35.0, -12.0), (41.0, 14.0), (14.0, 19.0)]


@query("footprint_pixels")
def footprint_pixels(spark, d):
    """Counts of stars by pixel, of those inside a footprint with zeros."""
    corners = F.array(*(F.struct(F.lit(a).alias("ra"), F.lit(b).alias("dec")) for a, b in FOOTPRINT))
    rows = spark.range(1).select(F.col("id").alias("solution_num"), corners.alias("corners"))
    pixels = solutions.footprint_pixels(rows, ["solution_num"], 5)
    stars = on_sky(load(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")), "k").select(F.lit(0).cast("long").alias("solution_num"), sky.healpix_nested(F.col("ra"), F.col("dec"), 5).alias("healpix"))
    return solutions.footprint_counts(pixels, stars, ["solution_num"], "healpix")
