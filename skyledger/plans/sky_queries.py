"""Catalogue queries, coordinates and crossmatches on the test tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from skyledger.functions import sky
from skyledger.operators import catalog, crossmatch
from skyledger.plans.binding import load, on_plane, on_sky, plane_sql, separation_sql, sky_sql
from skyledger.plans.registry import query

STARS = f"SELECT c_custkey AS source_id, {sky_sql('c_custkey')}, c_acctbal / 500.0::DOUBLE AS rp, CAST(c_nationkey AS DOUBLE) / 10.0::DOUBLE AS bp_rp FROM customer"


def stars(spark, d):
    return on_sky(load(spark, d, "customer"), "c_custkey").select(F.col("c_custkey").alias("source_id"), "ra", "dec", (F.col("c_acctbal") / 500.0).alias("rp"), (F.col("c_nationkey").cast("double") / 10.0).alias("bp_rp"))


@query(
    "cone_mag_query",
    f"""SELECT source_id, round(ra, 6) AS ra, round(dec, 6) AS dec, round(rp + 0.5::DOUBLE * bp_rp, 6) AS mag, bp_rp AS color_index FROM ({STARS})
    WHERE {separation_sql("ra", "dec", "150.0::DOUBLE", "20.0::DOUBLE")} < 40 AND rp + 0.5::DOUBLE * bp_rp >= 2 AND rp + 0.5::DOUBLE * bp_rp < 16""",
)
def cone_mag_query(spark, d):
    s = stars(spark, d).withColumn("g", catalog.passband(F.col("rp"), F.col("bp_rp"), 0.5))
    found = catalog.query_fields(s, [catalog.Solution(1, 150.0, 20.0, 40.0)], F.col("g"), 2, 16)
    return catalog.generic_names(found.select("source_id", "ra", "dec", "g", "bp_rp")).select("source_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"), F.round("mag", 6).alias("mag"), "color_index")


@query(
    "multi_field_query",
    "SELECT source_id, n AS solution_num FROM (" + STARS + ") , (VALUES (1, 20.0::DOUBLE, 10.0::DOUBLE), (2, 200.0::DOUBLE, -30.0::DOUBLE)) f(n, ra0, dec0) WHERE " + separation_sql("ra", "dec", "ra0", "dec0") + " < 15 AND rp >= 0 AND rp < 12",
)
def multi_field_query(spark, d):
    return catalog.query_fields(stars(spark, d), [catalog.Solution(1, 20.0, 10.0, 15.0), catalog.Solution(2, 200.0, -30.0, 15.0)], F.col("rp"), None, 12).select("source_id", "solution_num")


@query(
    "ra_dec_box_wrap",
    f"SELECT source_id, round(ra, 6) AS ra, round(dec, 6) AS dec FROM ({STARS}) WHERE dec > 0 AND dec < 20 AND (ra > 360 - 30 / cos(radians(20.0::DOUBLE)) + 5 OR ra < 5 + 30 / cos(radians(20.0::DOUBLE)))",
)
def ra_dec_box_wrap(spark, d):
    return stars(spark, d).filter(catalog.in_box(F.col("ra"), F.col("dec"), 5.0, 10.0, 30.0, 10.0)).select("source_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"))


@query("pole_cap", f"SELECT source_id FROM ({STARS}) WHERE dec >= 70")
def pole_cap(spark, d):
    return stars(spark, d).filter(catalog.in_box(F.col("ra"), F.col("dec"), 0.0, 80.0, 5.0, 10.0, inclusive=True)).select("source_id")


@query(
    "proper_motion_epoch",
    f"""SELECT p_partkey AS source_id, round(coalesce(ra + -60.0::DOUBLE * pmra / cos(radians(dec)) / 3.6e6, ra), 9) AS ra, round(coalesce(dec + -60.0::DOUBLE * pmdec / 3.6e6, dec), 9) AS dec
    FROM (SELECT p_partkey, {sky_sql("p_partkey")}, CASE WHEN p_size > 5 THEN CAST(p_size AS DOUBLE) END AS pmra, p_retailprice / 100.0::DOUBLE AS pmdec FROM part)""",
)
def proper_motion_epoch(spark, d):
    p = on_sky(load(spark, d, "part"), "p_partkey").select(F.col("p_partkey").alias("source_id"), "ra", "dec", F.when(F.col("p_size") > 5, F.col("p_size").cast("double")).alias("pmra"), (F.col("p_retailprice") / 100.0).alias("pmdec"))
    return catalog.at_epoch(p, 1956.0).select("source_id", F.round("ra", 9).alias("ra"), F.round("dec", 9).alias("dec"))


@query("unit_sphere", f"SELECT source_id, round(cos(radians(dec)) * cos(radians(ra)), 9) AS x_sphere, round(cos(radians(dec)) * sin(radians(ra)), 9) AS y_sphere, round(sin(radians(dec)), 9) AS z_sphere FROM ({STARS})")
def unit_sphere(spark, d):
    s = stars(spark, d)
    return s.select("source_id", *(F.round(v, 9).alias(n) for v, n in zip(sky.unit_vector(F.col("ra"), F.col("dec")), ("x_sphere", "y_sphere", "z_sphere"), strict=True)))


def _rotation_sql(m) -> str:
    rows = [" + ".join(f"({v!r}::DOUBLE) * {a}" for v, a in zip(r, "xyz", strict=True)) for r in m]
    return f"SELECT source_id, round(l - 360.0::DOUBLE * floor(l / 360.0::DOUBLE), 6) AS lon, round(degrees(asin(greatest(least(w, 1.0::DOUBLE), -1.0::DOUBLE))), 6) AS lat FROM (SELECT source_id, degrees(atan2({rows[1]}, {rows[0]})) AS l, {rows[2]} AS w FROM (SELECT source_id, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM ({STARS})))"


def _rotated(f):
    def run(spark, d):
        lon, lat = f(F.col("ra"), F.col("dec"))
        return stars(spark, d).select("source_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))

    return run


query("galactic", _rotation_sql(sky.GALACTIC))(_rotated(sky.galactic))
_COS, _SIN = math.cos(math.radians(sky.OBLIQUITY)), math.sin(math.radians(sky.OBLIQUITY))
query("ecliptic", _rotation_sql(((1.0, 0.0, 0.0), (0.0, _COS, _SIN), (0.0, -_SIN, _COS))))(_rotated(sky.ecliptic))
query("precession_b1950", _rotation_sql(sky.precession_matrix(1950.0)))(_rotated(lambda a, b: sky.precessed(a, b, 1950.0)))


@query(
    "airmass",
    f"""SELECT source_id, round(z, 6) AS zenith, round(CASE WHEN z < 90 THEN (1.002432::DOUBLE * c * c + 0.148386::DOUBLE * c + 0.0096467::DOUBLE) / (c * c * c + 0.149864::DOUBLE * c * c + 0.0102963::DOUBLE * c + 0.000303978::DOUBLE) END, 4) AS airmass
    FROM (SELECT *, cos(radians(z)) AS c FROM (SELECT source_id, degrees(acos(greatest(least(sin(radians(52.38056::DOUBLE)) * sin(radians(dec)) + cos(radians(52.38056::DOUBLE)) * cos(radians(dec)) * cos(radians(lst - ra)), 1.0::DOUBLE), -1.0::DOUBLE))) AS z
    FROM (SELECT *, s - 360.0::DOUBLE * floor(s / 360.0::DOUBLE) AS lst FROM (SELECT *, 280.46061837::DOUBLE + 360.98564736629::DOUBLE * (2435544.34479::DOUBLE - 2451545.0::DOUBLE) + 0.000387933::DOUBLE * ((2435544.34479::DOUBLE - 2451545.0::DOUBLE) / 36525.0::DOUBLE) * ((2435544.34479::DOUBLE - 2451545.0::DOUBLE) / 36525.0::DOUBLE) + 13.06417::DOUBLE AS s FROM ({STARS})))))""",
)
def airmass(spark, d):
    z = sky.zenith_angle(F.col("ra"), F.col("dec"), F.lit(2435544.34479), F.lit(13.06417), F.lit(52.38056))
    return stars(spark, d).withColumn("z", z).select("source_id", F.round("z", 6).alias("zenith"), F.round(sky.airmass(F.col("z")), 4).alias("airmass"))


def _healpix_sql(order: int, source: str) -> str:
    n = 1 << order

    def spread(v: str) -> str:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = f"(({v} | ({v} << {shift})) & {mask})"
        return v

    return f"""SELECT *, face * {n * n} + {spread("ix")} + ({spread("iy")} << 1) AS hpx FROM (
    SELECT *, CASE WHEN abs(z) <= 2.0 / 3.0 THEN CASE WHEN ifp = ifm THEN (ifp & 3) + 4 WHEN ifp < ifm THEN ifp ELSE ifm + 8 END WHEN z >= 0 THEN q ELSE q + 8 END AS face,
      CASE WHEN abs(z) <= 2.0 / 3.0 THEN jm & {n - 1} WHEN z >= 0 THEN {n - 1} - km ELSE kp END AS ix, CASE WHEN abs(z) <= 2.0 / 3.0 THEN {n - 1} - (jp & {n - 1}) WHEN z >= 0 THEN {n - 1} - kp ELSE km END AS iy
    FROM (SELECT *, jp >> {order} AS ifp, jm >> {order} AS ifm, least(CAST(floor((tt - q) * r) AS BIGINT), {n - 1}) AS kp, least(CAST(floor((1.0::DOUBLE - (tt - q)) * r) AS BIGINT), {n - 1}) AS km
    FROM (SELECT *, CAST(floor({float(n)}::DOUBLE * (0.5::DOUBLE + tt - z * 0.75::DOUBLE)) AS BIGINT) AS jp, CAST(floor({float(n)}::DOUBLE * (0.5::DOUBLE + tt + z * 0.75::DOUBLE)) AS BIGINT) AS jm, least(CAST(floor(tt) AS BIGINT), 3) AS q, {float(n)}::DOUBLE * sqrt(3.0::DOUBLE * (1.0::DOUBLE - abs(z))) AS r
    FROM (SELECT *, sin(radians(dec)) AS z, (ra - 360.0::DOUBLE * floor(ra / 360.0::DOUBLE)) / 90.0::DOUBLE AS tt FROM ({source})))))"""


@query("healpix_index", f"SELECT a.source_id, a.hpx AS healpix256, b.hpx AS healpix1024 FROM ({_healpix_sql(8, STARS)}) a JOIN ({_healpix_sql(10, STARS)}) b USING (source_id)")
def healpix_index(spark, d):
    return stars(spark, d).select("source_id", sky.healpix_nested(F.col("ra"), F.col("dec"), 8).alias("healpix256"), sky.healpix_nested(F.col("ra"), F.col("dec"), 10).alias("healpix1024"))


@query("healpix_density_zero_fill", f"SELECT hpx, sum(n)::BIGINT AS num_sources FROM (SELECT range AS hpx, 0 AS n FROM range(192) UNION ALL SELECT hpx, count(*) FROM ({_healpix_sql(2, STARS)}) WHERE rp >= 5 GROUP BY hpx) GROUP BY hpx")
def healpix_density_zero_fill(spark, d):
    counts = stars(spark, d).filter("rp >= 5").groupBy(sky.healpix_nested(F.col("ra"), F.col("dec"), 2).alias("hpx")).agg(F.count(F.lit(1)).alias("n"))
    zeros = spark.range(192).select(F.col("id").alias("hpx"), F.lit(0).cast("long").alias("n"))
    return zeros.unionByName(counts).groupBy("hpx").agg(F.sum("n").alias("num_sources"))


@query(
    "angular_separation",
    f"""SELECT source_id, round({separation_sql("ra", "dec", "83.6::DOUBLE", "22.0::DOUBLE")}, 7) AS sep, round(p - 360.0::DOUBLE * floor(p / 360.0::DOUBLE), 5) AS angle FROM (SELECT *, degrees(atan2(sin(radians(83.6::DOUBLE - ra)) * cos(radians(22.0::DOUBLE)), cos(radians(dec)) * sin(radians(22.0::DOUBLE)) - sin(radians(dec)) * cos(radians(22.0::DOUBLE)) * cos(radians(83.6::DOUBLE - ra)))) AS p FROM ({STARS}))""",
)
def angular_separation(spark, d):
    a = (F.col("ra"), F.col("dec"), F.lit(83.6), F.lit(22.0))
    return stars(spark, d).select("source_id", F.round(sky.separation(*a), 7).alias("sep"), F.round(sky.position_angle(*a), 5).alias("angle"))


@query(
    "tan_projection",
    f"""WITH s AS (SELECT *, radians(dec) AS d, radians(ra - 40.0::DOUBLE) AS da, radians(30.0::DOUBLE) AS d0 FROM ({STARS})),
    f AS (SELECT *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(da) AS c FROM s)
    SELECT source_id, round(5000.0::DOUBLE - degrees(cos(d) * sin(da) / c) / 0.01::DOUBLE, 4) AS x, round(4000.0::DOUBLE + degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(da)) / c) / 0.01::DOUBLE, 4) AS y FROM f
    WHERE c > 0 AND 5000.0::DOUBLE - degrees(cos(d) * sin(da) / c) / 0.01::DOUBLE > 0.5 AND 5000.0::DOUBLE - degrees(cos(d) * sin(da) / c) / 0.01::DOUBLE < 10000
    AND 4000.0::DOUBLE + degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(da)) / c) / 0.01::DOUBLE > 0.5 AND 4000.0::DOUBLE + degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(da)) / c) / 0.01::DOUBLE < 8000""",
)
def tan_projection(spark, d):
    x, y = sky.tan_pixel(F.col("ra"), F.col("dec"), F.lit(40.0), F.lit(30.0), F.lit(0.01), F.lit(5000.0), F.lit(4000.0))
    return stars(spark, d).select("source_id", x.alias("x"), y.alias("y")).filter("x > 0.5 AND x < 10000 AND y > 0.5 AND y < 8000").select("source_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


POINTS = f"SELECT o_orderkey AS id, {plane_sql('o_orderkey')} FROM orders"
REFS = f"SELECT c_custkey AS id, {plane_sql('c_custkey')} FROM customer"
PARTS = f"SELECT p_partkey AS id, {plane_sql('p_partkey')} FROM part"
DIST = "sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))"


def points(spark, d, name, key):
    return on_plane(load(spark, d, name), key).select(F.col(key).alias("id"), "x", "y")


def _points_refs(spark, d):
    return points(spark, d, "orders", "o_orderkey"), points(spark, d, "customer", "c_custkey")


@query("nearest_match_tol", f"SELECT a.id AS left_id, min_by(b.id, ROW({DIST}, b.id)) AS right_id, round(min({DIST}), 9) AS dist FROM ({POINTS}) a JOIN ({REFS}) b ON {DIST} < 60 GROUP BY a.id")
def nearest_match_tol(spark, d):
    return crossmatch.nearest_match(*_points_refs(spark, d), 60.0, "id", "id").withColumn("dist", F.round("dist", 9))


@query("all_neighbours", f"SELECT a.id AS left_id, b.id AS right_id, round({DIST}, 9) AS dist FROM ({POINTS}) a JOIN ({REFS}) b ON {DIST} < 60")
def all_neighbours(spark, d):
    return crossmatch.all_pairs(*_points_refs(spark, d), 60.0, "id", "id", measure=lambda dist: F.round(dist, 9))


@query(
    "flag_xmatch",
    f"WITH p AS (SELECT a.id AS left_id, b.id AS right_id, {DIST} AS dist FROM ({POINTS}) a JOIN ({REFS}) b ON {DIST} < 80), m AS (SELECT left_id, min_by(right_id, ROW(dist, right_id)) AS best FROM p WHERE dist < 40 GROUP BY left_id) SELECT p.left_id, right_id, CASE WHEN best = right_id THEN 1 ELSE 0 END AS flag_xmatch FROM p LEFT JOIN m USING (left_id)",
)
def flag_xmatch(spark, d):
    return crossmatch.flagged_pairs(*_points_refs(spark, d), 80.0, 40.0, "id", "id").select("left_id", "right_id", "flag_xmatch")


@query("neighbour_counts", f"SELECT a.id AS left_id, count(b.id) AS neighbours FROM ({POINTS}) a LEFT JOIN ({REFS}) b ON {DIST} < 60 GROUP BY a.id")
def neighbour_counts(spark, d):
    return crossmatch.neighbour_counts(*_points_refs(spark, d), 60.0, "id", "id")


@query("nn_self_plane", f"SELECT a.id AS left_id, min_by(b.id, ROW({DIST}, b.id)) AS right_id, round(min({DIST}), 9) AS dist FROM ({PARTS}) a JOIN ({PARTS}) b ON a.id <> b.id AND {DIST} < 300 GROUP BY a.id")
def nn_self_plane(spark, d):
    return crossmatch.nearest_others(points(spark, d, "part", "p_partkey"), 300.0, "id").select("left_id", "right_id", F.round("dist", 9).alias("dist"))


@query("nn_self_plane_all", f"SELECT a.id AS left_id, min_by(b.id, ROW({DIST}, b.id)) AS right_id, round(min({DIST}), 9) AS dist FROM ({PARTS}) a JOIN ({PARTS}) b ON a.id <> b.id GROUP BY a.id")
def nn_self_plane_all(spark, d):
    return crossmatch.all_nearest_others(points(spark, d, "part", "p_partkey"), "id").select("left_id", "right_id", F.round("dist", 9).alias("dist"))


@query("isolated_points", f"SELECT a.id FROM ({PARTS}) a WHERE NOT EXISTS (SELECT 1 FROM ({PARTS}) b WHERE a.id <> b.id AND {DIST} <= 100)")
def isolated_points(spark, d):
    return crossmatch.isolated(points(spark, d, "part", "p_partkey"), 100.0, "id").select("id")


@query(
    "two_nn_angle",
    f"""WITH p AS (SELECT a.id, b.x - a.x AS dx, b.y - a.y AS dy, row_number() OVER (PARTITION BY a.id ORDER BY {DIST}, b.id) AS nth FROM ({PARTS}) a JOIN ({PARTS}) b ON a.id <> b.id AND {DIST} < 400)
    SELECT p.id AS left_id, round(p.dx * q.dx + p.dy * q.dy, 3) AS dot FROM p JOIN p q ON p.id = q.id AND p.nth = 1 AND q.nth = 2 WHERE p.dx * q.dx + p.dy * q.dy > 0""",
)
def two_nn_angle(spark, d):
    p = points(spark, d, "part", "p_partkey")
    return _same_side(p, crossmatch.nearest_others(p, 400.0, "id", 2))


@query(
    "two_nn_angle_all",
    f"""WITH p AS (SELECT a.id, b.x - a.x AS dx, b.y - a.y AS dy, row_number() OVER (PARTITION BY a.id ORDER BY {DIST}, b.id) AS nth FROM ({PARTS}) a JOIN ({PARTS}) b ON a.id <> b.id)
    SELECT p.id AS left_id, round(p.dx * q.dx + p.dy * q.dy, 3) AS dot FROM p JOIN p q ON p.id = q.id AND p.nth = 1 AND q.nth = 2 WHERE p.dx * q.dx + p.dy * q.dy > 0""",
)
def two_nn_angle_all(spark, d):
    p = points(spark, d, "part", "p_partkey")
    return _same_side(p, crossmatch.all_nearest_others(p, "id", 2))


def _same_side(p, two):
    """Points whose two nearest others lie within a right angle, with the dot product."""
    at = lambda df, k, tag: df.join(p.select(F.col("id").alias(k), F.col("x").alias(f"{tag}x"), F.col("y").alias(f"{tag}y")).hint("merge"), k)
    placed = at(at(two, "left_id", "a"), "right_id", "b").withColumns({"dx": F.col("bx") - F.col("ax"), "dy": F.col("by") - F.col("ay")})
    one = lambda c, n: F.max(F.when(F.col("nth") == n, F.col(c)))
    dots = placed.groupBy("left_id").agg((one("dx", 1) * one("dx", 2) + one("dy", 1) * one("dy", 2)).alias("dot"))
    return dots.filter("dot > 0").select("left_id", F.round("dot", 3).alias("dot"))


@query(
    "psf_overwrite",
    f"WITH m AS (SELECT a.id, min_by(b.x, ROW({DIST}, b.id)) AS bx, min_by(b.y, ROW({DIST}, b.id)) AS byy FROM ({POINTS}) a JOIN ({REFS}) b ON {DIST} < 30 GROUP BY a.id) SELECT a.id, coalesce(bx, x) AS x, coalesce(byy, y) AS y, CASE WHEN bx IS NULL THEN 0 ELSE 1 END AS flag_usepsf FROM ({POINTS}) a LEFT JOIN m USING (id)",
)
def psf_overwrite(spark, d):
    return crossmatch.overwritten(*_points_refs(spark, d), 30.0, "id", "id", ["x", "y"], "flag_usepsf")


@query("spatial_anti", f"SELECT a.id, x, y FROM ({POINTS}) a WHERE NOT EXISTS (SELECT 1 FROM ({REFS}) b WHERE {DIST} <= 50)")
def spatial_anti(spark, d):
    return crossmatch.unmatched(*_points_refs(spark, d), 50.0, "id", "id").select("id", "x", "y")


@query("sky_neighbours", f"WITH s AS ({STARS}) SELECT a.source_id AS left_id, b.source_id AS right_id, round({separation_sql('a.ra', 'a.dec', 'b.ra', 'b.dec')}, 6) AS dist FROM s a JOIN s b ON a.source_id < b.source_id AND {separation_sql('a.ra', 'a.dec', 'b.ra', 'b.dec')} < 3.0")
def sky_neighbours(spark, d):
    s = stars(spark, d)
    return crossmatch.sky_pairs(s, s, 3.0, "source_id", "source_id").filter("left_id < right_id").withColumn("dist", F.round("dist", 6))


@query("pattern_search", f"WITH p AS ({PARTS}) SELECT id FROM p c WHERE EXISTS (SELECT 1 FROM p b WHERE sqrt(pow(c.x + 100 - b.x, 2) + pow(c.y + 60 - b.y, 2)) < 150) AND EXISTS (SELECT 1 FROM p b WHERE sqrt(pow(c.x - 200 - b.x, 2) + pow(c.y + 150 - b.y, 2)) < 150)")
def pattern_search(spark, d):
    return crossmatch.pattern_centres(points(spark, d, "part", "p_partkey"), [(100.0, 60.0), (-200.0, 150.0)], 150.0, "id")


@query("append_unseen", "SELECT c_custkey AS source_id, c_name AS name, CAST(NULL AS DOUBLE) AS mag FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, CAST(NULL AS VARCHAR), c_acctbal FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0")
def append_unseen(spark, d):
    c = load(spark, d, "customer")
    old = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name"))
    return catalog.append_unseen(old, c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("source_id"), F.col("c_acctbal").alias("mag")))


@query("remaining_queue", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def remaining_queue(spark, d):
    done = load(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return catalog.remaining(load(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@query(
    "gap_fill_by_cell",
    """WITH s AS (SELECT p_partkey AS id, p_brand AS cell, CASE WHEN p_partkey % 7 = 0 THEN p_retailprice / 100 END AS b, CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size AS DOUBLE) END AS v, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice / 90 END AS b2, CAST(p_size AS DOUBLE) + 5 AS v2 FROM part),
    m AS (SELECT *, b IS NOT NULL AND v IS NOT NULL AND NOT (b <= 10 AND v <= 10) AS good, coalesce(b2 > 10 AND v2 > 10, false) AS cand FROM s),
    w AS (SELECT *, count(*) FILTER (good) OVER (PARTITION BY cell) AS goods, count(*) FILTER (cand) OVER (PARTITION BY cell) AS cands FROM m),
    f AS (SELECT *, cand AND NOT good AND goods <= 10 AND cands > goods AS fill FROM w)
    SELECT id, round(CASE WHEN fill THEN b2 ELSE b END, 6) AS b, CASE WHEN fill THEN v2 ELSE v END AS v, CAST(fill AS INT) AS filled FROM f""",
)
def gap_fill_by_cell(spark, d):
    p = load(spark, d, "part")
    seventh = F.col("p_partkey") % 7 == 0
    s = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("cell"), F.when(seventh, F.col("p_retailprice") / 100).alias("b"), F.when(seventh, F.col("p_size").cast("double")).alias("v"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice") / 90).alias("b2"), (F.col("p_size").cast("double") + 5).alias("v2"))
    return catalog.gap_filled(s).select("id", F.round("b", 6).alias("b"), "v", "filled")
