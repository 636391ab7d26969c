"""Exposure patterns and reference reads on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions import sky
from skyledger.operators import cover, exposures, fits, photometry, records
from skyledger.plans.binding import load, new_path, on_plane, on_sky, separation_sql, sky_sql, spread
from skyledger.plans.registry import query


def planted_exposures(spark, d):
    """Stars (the parts) on plates of 40, each with an image for every exposure: turned and scaled by its place on the plate, with
    noise. Of every ten stars one lacks its third image and one has a single image."""
    k, c = F.col("p_partkey"), F.col
    stars = spread(load(spark, d, "part").select(k)).select(k, F.floor(k / 40).alias("plate"), (k % 40).alias("n")).withColumns({"numexp": (5 + c("plate") % 3).cast("int")})
    stars = stars.withColumns({"x0": 700 + c("n") % 8 * 1100 + k * 7919 % 211, "y0": 800 + F.floor(c("n") / 8) * 1500 + k * 104729 % 197, "e": F.explode(F.sequence(F.lit(0).cast("long"), (c("numexp") - 1).cast("long")))})
    images = stars.where(~((k % 10 == 3) & (c("e") == 2)) & ~((k % 10 == 7) & (c("e") > 0)))
    along, across = (c("e") * 40 + c("e") * c("e") * 3).cast("double"), (c("e") * c("e") * 7 % 11).cast("double")
    upright = c("plate") % 2 == 1
    dx, dy = F.when(upright, across).otherwise(along), F.when(upright, along).otherwise(across)
    angle, scale = F.radians((c("x0") - 5000) * 0.0006 + (c("y0") - 4000) * 0.0003), 1 + (c("y0") - 4000) * 2e-6
    noise = lambda a, m: ((k * 16 + c("e")) * a % m - (m - 1) / 2) / m
    sources = images.select("plate", (k * 16 + c("e")).alias("id"), (c("x0") + scale * (dx * F.cos(angle) - dy * F.sin(angle)) + noise(31, 7)).alias("x"), (c("y0") + scale * (dx * F.sin(angle) + dy * F.cos(angle)) + noise(17, 11)).alias("y"), (10 + k * 13 % 40 / 10 + noise(19, 5) / 20).alias("mag"))
    plates = stars.select("plate", "numexp", F.lit(40.0).alias("dist_peak"), F.lit(10000).alias("width"), F.lit(8000).alias("height")).distinct()
    return sources, plates


@query("exposure_numbers", "SELECT p_partkey * 16 + e.range AS id, CASE WHEN p_partkey % 10 IN (3, 7) THEN 0 ELSE e.range + 1 END AS exposure_num FROM part, range(0, 7) e WHERE e.range < 5 + p_partkey // 40 % 3 AND NOT (p_partkey % 10 = 3 AND e.range = 2) AND NOT (p_partkey % 10 = 7 AND e.range > 0)")
def exposure_numbers(spark, d):
    return exposures.exposure_numbers(*planted_exposures(spark, d)).select("id", F.col("exposure_num").cast("long").alias("exposure_num"))


@query(
    "exposure_pattern",
    "WITH p AS (SELECT DISTINCT p_partkey // 40 AS plate FROM part), e AS (SELECT plate, e.range AS e, e.range * 40 + e.range * e.range * 3 AS along, e.range * e.range * 7 % 11 AS across, 5 + plate % 3 AS n FROM p, range(0, 7) e WHERE e.range < 5 + plate % 3) SELECT plate, e + 1 AS exposure_num, true AS near, n AS num_exposures FROM e",
)
def exposure_pattern(spark, d):
    """The pattern of each plate, compared with the planted one: places within 3 pixels of theirs but for the scale and rotation of the
    star in the middle, to which the pattern refers."""
    members = fits.checkpointed(exposures.regular_clusters(exposures.star_clusters(*planted_exposures(spark, d))))
    places = exposures.exposure_places(members, fits.checkpointed(exposures.planes(members)))
    e = F.col("exposure_num") - 1
    along, across, upright = e * 40 + e * e * 3, e * e * 7 % 11, F.col("plate") % 2 == 1
    off = F.hypot(F.col("dx") - F.when(upright, across).otherwise(along), F.col("dy") - F.when(upright, along).otherwise(across))
    return places.select("plate", F.col("exposure_num").cast("long").alias("exposure_num"), (off < 3 + 0.02 * along).alias("near"), F.col("num_exposures").cast("long").alias("num_exposures"))


#: Fields of three plates: one over the zero meridian, one by the pole, one anywhere.
FIELDS = [cover.Field(n, ra, dec, 6.4, (5000.0, 4000.0), (-0.001, 0.00005, 0.00005, 0.001), 10000.0, 8000.0) for n, ra, dec in ((1, 0.5, 12.0), (2, 200.0, 86.0), (3, 120.0, -40.0))]
_MOVED = "SELECT id, mag, ra + 43.5::DOUBLE * pmra / cos(radians(dec)) / 3600000 AS r, dec + 43.5::DOUBLE * pmdec / 3600000 AS dec FROM"


def _catalogue(spark, d):
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = load(spark, d, "lineitem").groupBy(k.alias("id")).agg((F.min("l_quantity") / 4).alias("mag"))
    return on_sky(rows, "id").withColumns({"pmra": (F.col("id") % 401 - 200).cast("double"), "pmdec": (F.col("id") % 301 - 150).cast("double")})


def _field_sql(f) -> str:
    facing = f"(sin(radians({f.dec}::DOUBLE)) * sin(radians(dec)) + cos(radians({f.dec}::DOUBLE)) * cos(radians(dec)) * cos(radians(ra - {f.ra}::DOUBLE)))"
    xi = f"degrees(cos(radians(dec)) * sin(radians(ra - {f.ra}::DOUBLE)) / {facing})"
    eta = f"degrees((cos(radians({f.dec}::DOUBLE)) * sin(radians(dec)) - sin(radians({f.dec}::DOUBLE)) * cos(radians(dec)) * cos(radians(ra - {f.ra}::DOUBLE))) / {facing})"
    a, b, c, e = f.cd
    det = a * e - b * c
    x, y = f"{f.crpix[0]}::DOUBLE + ({e!r}::DOUBLE * xi - ({b!r}::DOUBLE) * eta) / ({det!r}::DOUBLE)", f"{f.crpix[1]}::DOUBLE + (({a!r}::DOUBLE) * eta - ({c!r}::DOUBLE) * xi) / ({det!r}::DOUBLE)"
    near = f"{separation_sql('ra', 'dec', f'{f.ra}::DOUBLE', f'{f.dec}::DOUBLE')} < {f.half_diagonal}::DOUBLE"
    return f"SELECT id, {f.number} AS solution_num, mag, x, y FROM (SELECT *, {x} AS x, {y} AS y FROM (SELECT id, mag, {xi} AS xi, {eta} AS eta FROM c WHERE {near} AND {facing} > 0)) WHERE x > 0 AND x < {f.width} AND y > 0 AND y < {f.height}"


@query(
    "reference_read",
    f"""WITH s AS (SELECT l_orderkey * 8 + l_linenumber AS id, min(l_quantity) / 4 AS mag FROM lineitem GROUP BY 1), p AS (SELECT *, {sky_sql("id")}, (id % 401 - 200)::DOUBLE AS pmra, (id % 301 - 150)::DOUBLE AS pmdec FROM s),
    c AS (SELECT id, mag, r - 360.0::DOUBLE * floor(r / 360.0::DOUBLE) AS ra, dec FROM ({_MOVED} (SELECT * REPLACE (-pmra AS pmra, -pmdec AS pmdec) FROM p)) WHERE mag >= 2 AND mag < 9)
    SELECT id, CAST(solution_num AS INTEGER) AS solution_num, mag, round(x, 3) AS x_ref, round(y, 3) AS y_ref FROM ({" UNION ALL ".join(map(_field_sql, FIELDS))})""",
)
def reference_read(spark, d):
    """The catalogue stored by pixels, then the stars of three fields at the plates' epoch read from it."""
    path = new_path(spark, "stars")
    cover.write_clustered(_catalogue(spark, d), path)
    found = cover.reference_stars(spark.read.parquet(path), FIELDS, 1972.5, "mag", 2.0, 9.0)
    return found.select("id", "solution_num", "mag", F.round("x_ref", 3).alias("x_ref"), F.round("y_ref", 3).alias("y_ref"))


@query("cone_cover_join", f"WITH s AS (SELECT c_custkey AS source_id, {sky_sql('c_custkey')} FROM customer), f AS (SELECT s_suppkey AS field, ra AS fra, dec AS fdec FROM (SELECT *, {sky_sql('s_suppkey * 7 + 3')} FROM supplier)) SELECT field, count(source_id) AS n, coalesce(max(source_id), -1) AS last FROM f LEFT JOIN s ON {separation_sql('ra', 'dec', 'fra', 'fdec')} < 4 GROUP BY field")
def cone_cover_join(spark, d):
    """Stars of each of many fields: the table function's pixels at mixed orders, joined with the stars' pixels of that order."""
    cover.register_functions(spark)
    fields = on_sky(load(spark, d, "supplier").withColumn("k", F.col("s_suppkey") * 7 + 3), "k").select(F.col("s_suppkey").alias("field"), F.col("ra").alias("fra"), F.col("dec").alias("fdec"))
    stars = on_sky(load(spark, d, "customer"), "c_custkey").select(F.col("c_custkey").alias("source_id"), "ra", "dec", sky.healpix_nested(F.col("ra"), F.col("dec"), 6).alias("finest"))
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright("finest", 2 * (6 - k)).alias("pixel")) for k in range(7)))).alias("p")
    return spark.sql(
        """SELECT /*+ MERGE(s) */ field, count(source_id) AS n, coalesce(max(source_id), -1) AS last FROM (SELECT * FROM {fields}, LATERAL healpix_cone(fra, fdec, 4D, 6)) f
        LEFT JOIN {stars} s ON f.level = s.level AND f.pixel = s.pixel AND sky_separation(ra, dec, fra, fdec) < 4 GROUP BY field""",
        fields=fields, stars=stars.select("source_id", "ra", "dec", levels).select("source_id", "ra", "dec", "p.level", "p.pixel"),
    )


def _tilted(spark, d):
    """Stars on plates whose natural magnitude follows from RP by a colour term of 0.5; the plate's own has a slope over the plate
    of 0.6 mag, and one that grows with the magnitude."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = load(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("plate"), k.alias("id")).agg(F.count(F.lit(1)).alias("copies"))
    unit = lambda a, m: (F.col("id") * a % m) / F.lit(float(m))
    stars = on_plane(rows, "id").withColumns({"rp": 9 + 6 * F.sqrt(unit(7919, 9973)), "colour": 0.2 + 2 * unit(104729, 7919)}).withColumn("truth", F.col("rp") + 0.5 * F.col("colour"))
    tilt = (F.col("x") - 5000) / 10000 * 0.6 + (F.col("y") - 4000) / 8000 * (F.col("truth") - 12) * 0.06
    noise = (unit(15485863, 101) - 0.5) * 0.02
    return stars.withColumns({"mag": (F.col("truth") - tilt - 20) / 1.1 + noise, "bp": F.col("rp") + F.col("colour"), "bp_rp": F.col("colour")})


@query(
    "corrected_magnitudes",
    "WITH s AS (SELECT l_suppkey AS plate, l_orderkey * 8 + l_linenumber AS id FROM lineitem GROUP BY ALL) SELECT plate, count(*) AS n, true AS mostly_near, true AS flat, true AS was_tilted, true AS term_near, count(*) AS n_mags FROM s GROUP BY plate",
)
def corrected_magnitudes(spark, d):
    """Each plate's calibration with the correction over the plate, applied to all its sources: the slope over the plate that they had
    before is gone, and against the planted truth nearly all are near, but for those within a magnitude of the ends of the
    catalogue, where the curve rests on stars of one side."""
    stars = _tilted(spark, d)
    found = photometry.corrected_solutions(stars, ["plate"])
    rows = photometry.corrected_magnitudes(stars, fits.checkpointed(found), ["plate"])
    off, before = F.col("natmag") - F.col("truth"), F.col("natmag_plate") - F.col("truth")
    slope = lambda v: F.abs(F.regr_slope(v, F.col("x"))) * 10000
    return rows.groupBy("plate").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.when(F.col("rp").between(10, 14), (F.abs(off) < 0.1).cast("int"))) > 0.97).alias("mostly_near"), (slope(off) < 0.03).alias("flat"), (slope(before) > 0.4).alias("was_tilted"), (F.abs(F.first("color_term") - 0.5) < 0.03).alias("term_near"), F.count("natmag").alias("n_mags")
    )


_C = "FROM customer"
CASCADE = f"""WITH scan AS (SELECT c_custkey AS k, 'f' || c_custkey AS stem, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 4 <> 0 THEN 'p' || c_custkey END AS p0, CASE WHEN c_custkey % 13 = 0 THEN 'w' || c_custkey END AS w0 {_C}),
    plate AS (SELECT 'p' || c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN 'w' || c_custkey END AS w, 'o' || c_custkey AS observer, CASE WHEN c_custkey % 7 < 3 THEN 'plate-' || c_custkey END AS emulsion {_C} WHERE c_custkey % 5 <> 0 UNION ALL SELECT 'f' || c_custkey, NULL, 'by name', NULL {_C} WHERE c_custkey % 7 = 0),
    main AS (SELECT 'w' || c_custkey AS key, 'mw' || c_custkey AS object, 'main' AS emulsion {_C} WHERE c_custkey % 6 < 4 UNION ALL SELECT 'p' || c_custkey, 'mp' || c_custkey, NULL {_C} WHERE c_custkey % 8 < 3 UNION ALL SELECT 'f' || c_custkey, 'mf' || c_custkey, NULL {_C} WHERE c_custkey % 9 = 0),
    note AS (SELECT 'p' || c_custkey AS key, CASE WHEN c_custkey % 10 < 5 THEN 'np' || c_custkey END AS object, 'note' AS observer {_C} WHERE c_custkey % 4 < 3),
    a AS (SELECT s.*, coalesce(w0, pl.w, CASE WHEN m.key IS NOT NULL THEN p0 END) AS w1 FROM scan s LEFT JOIN plate pl ON pl.key = s.p0 LEFT JOIN main m ON m.key = s.p0),
    b AS (SELECT a.*, p0 IS NULL AND w1 IS NULL AND mf.key IS NOT NULL AS by_list, p0 IS NULL AND w1 IS NULL AND pf.key IS NOT NULL AS by_plate FROM a LEFT JOIN main mf ON mf.key = a.stem LEFT JOIN plate pf ON pf.key = a.stem),
    c AS (SELECT k, stem, p0, CASE WHEN by_list THEN stem ELSE w1 END AS w, CASE WHEN by_list OR by_plate THEN stem ELSE coalesce(p0, w1) END AS p FROM b)"""


def _keyed(spark, d):
    k, c = F.col("c_custkey"), load(spark, d, "customer").select("c_custkey")
    named = lambda letter: F.concat(F.lit(letter), k.cast("string"))
    none = F.lit(None).cast("string")
    scans = c.select(k.alias("k"), F.concat(named("f"), F.lit(".fits")).alias("filename"), F.when((k % 3 != 0) & (k % 4 != 0), named("p")).alias("plate_id"), F.when(k % 13 == 0, named("w")).alias("wfpdb_id"))
    plates = c.where(k % 5 != 0).select(named("p").alias("key"), F.when(k % 2 == 0, named("w")).alias("wfpdb_id"), named("o").alias("observer"), F.when(k % 7 < 3, named("plate-")).alias("emulsion"))
    plates = plates.unionByName(c.where(k % 7 == 0).select(named("f").alias("key"), none.alias("wfpdb_id"), F.lit("by name").alias("observer"), none.alias("emulsion")))
    main = c.where(k % 6 < 4).select(named("w").alias("key"), named("mw").alias("object"), F.lit("main").alias("emulsion"))
    for letter, chosen in (("p", k % 8 < 3), ("f", k % 9 == 0)):
        main = main.unionByName(c.where(chosen).select(named(letter).alias("key"), named(f"m{letter}").alias("object"), none.alias("emulsion")))
    notes = c.where(k % 4 < 3).select(named("p").alias("key"), F.when(k % 10 < 5, named("np")).alias("object"), F.lit("note").alias("observer"))
    return scans, plates, main, notes


@query("key_fallbacks", f"{CASCADE} SELECT k, p AS plate_id, w AS wfpdb_id FROM c")
def key_fallbacks(spark, d):
    scans, plates, main, _ = _keyed(spark, d)
    return records.resolved_keys(scans, plates.withColumnRenamed("key", "plate_id"), main).select("k", "plate_id", "wfpdb_id")


@query(
    "metadata_cascade",
    f"""{CASCADE} SELECT c.k, coalesce(coalesce(nw.object, CASE WHEN nw.key IS NULL THEN np.object END), coalesce(mw.object, CASE WHEN mw.key IS NULL THEN mp.object END)) AS object, coalesce(pl.observer, coalesce(nw.observer, CASE WHEN nw.key IS NULL THEN np.observer END)) AS observer,
    coalesce(CASE WHEN c.k % 11 = 0 THEN 'scan' END, pl.emulsion, coalesce(mw.emulsion, CASE WHEN mw.key IS NULL THEN mp.emulsion END)) AS emulsion
    FROM c LEFT JOIN main mw ON mw.key = c.w LEFT JOIN main mp ON mp.key = c.p LEFT JOIN note nw ON nw.key = c.w LEFT JOIN note np ON np.key = c.p LEFT JOIN plate pl ON pl.key = c.p""",
)
def metadata_cascade(spark, d):
    """Main list and notes by wfpdb_id, else plate_id; then the plates' records, then the scans' own."""
    scans, plates, main, notes = _keyed(spark, d)
    items = records.resolved_keys(scans, plates.withColumnRenamed("key", "plate_id"), main)
    own = scans.where(F.col("k") % 11 == 0).select(F.col("filename").alias("key"), F.lit("scan").alias("emulsion"))
    both = ["wfpdb_id", "plate_id"]
    return records.cascaded(items, "k", [(main, both), (notes, both), (plates, ["plate_id"]), (own, ["filename"])], ["object", "observer", "emulsion"])


#: A rotated matrix of about 1.5 seconds of arc a pixel, and distortions with terms of the radius.
CD = (-0.00042, 0.00003, 0.00003, 0.00042)
PV1, PV2 = {0: 1e-4, 1: 1.001, 2: -2e-4, 4: 3e-4, 5: -2e-4, 7: 5e-5, 9: 2e-5, 11: 4e-5, 17: 1e-6}, {0: -5e-5, 1: 0.9995, 2: 3e-4, 4: 1e-4, 6: 2e-4, 8: -3e-5, 10: 1e-5, 11: 3e-5, 23: 1e-6}


def _tpv_sql(pv, x: str, y: str) -> str:
    terms = sky.tpv_terms()
    return " + ".join(f"({c!r}::DOUBLE) * pow({x}, {terms[k][0]}) * pow({y}, {terms[k][1]}) * pow(sqrt(u * u + v * v), {terms[k][2]})" for k, c in pv.items())


@query(
    "tpv_round_trip",
    f"""WITH p AS (SELECT p_partkey, (p_partkey * 7919 % 10000)::DOUBLE AS x, (p_partkey * 104729 % 8000)::DOUBLE AS y FROM part), l AS (SELECT *, ({CD[0]}) * (x - 5000) + ({CD[1]}) * (y - 4000) AS u, ({CD[2]}) * (x - 5000) + ({CD[3]}) * (y - 4000) AS v FROM p),
    t AS (SELECT *, radians({_tpv_sql(PV1, "u", "v")}) AS xi, radians({_tpv_sql(PV2, "v", "u")}) AS eta, cos(radians(55.0::DOUBLE)) AS c, sin(radians(55.0::DOUBLE)) AS s FROM l)
    SELECT p_partkey, round(310.0::DOUBLE + degrees(atan2(xi, c - eta * s)), 9) AS ra, round(degrees(atan2(s + eta * c, sqrt(xi * xi + pow(c - eta * s, 2)))), 9) AS dec, x, y FROM t""",
)
def tpv_round_trip(spark, d):
    p = on_plane(spread(load(spark, d, "part").select("p_partkey")), "p_partkey").select("p_partkey", "x", "y")
    at = (F.lit(310.0), F.lit(55.0), (F.lit(5000.0), F.lit(4000.0)), tuple(map(F.lit, CD)), PV1, PV2)
    ra, dec = sky.tpv_sky(F.col("x"), F.col("y"), *at)
    there = p.select("p_partkey", ra.alias("ra"), dec.alias("dec"))
    x, y = sky.tpv_pixel(F.col("ra"), F.col("dec"), *at)
    back = there.withColumns({"x": x, "y": y})
    return back.select("p_partkey", F.round("ra", 9).alias("ra"), F.round("dec", 9).alias("dec"), F.round("x", 8).alias("x"), F.round("y", 8).alias("y"))
