"""Detections, calibration statistics, records and times on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import sky, text, times
from skyledger.operators import detections, fits, photometry, records
from skyledger.plans.binding import load, on_plane, plane_sql
from skyledger.plans.registry import query

WIDTH, HEIGHT = 10000.0, 8000.0
SOURCES = f"""SELECT id, plate, {plane_sql("id")}, background, flux_radius, elongation, magerr, mag, bp, rp FROM (SELECT l_orderkey * 8 + l_linenumber AS id, l_suppkey AS plate, sum(l_extendedprice) / 1000 AS background, sum(l_quantity) - 2 AS flux_radius,
    1 + min(l_quantity) / 10 AS elongation, min(l_discount) * 60 AS magerr, min(l_extendedprice) / 5000 AS mag, min(l_quantity) / 3 AS bp, min(l_discount) * 10 AS rp FROM lineitem GROUP BY l_orderkey, l_linenumber, l_suppkey)"""


def sources(spark, d):
    li = load(spark, d, "lineitem")
    s = li.groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("plate")).agg(
        (F.sum("l_extendedprice") / 1000).alias("background"), (F.sum("l_quantity") - 2).alias("flux_radius"), (F.min("l_quantity") / 10 + 1).alias("elongation"), (F.min("l_discount") * 60).alias("magerr"),
        (F.min("l_extendedprice") / 5000).alias("mag"), (F.min("l_quantity") / 3).alias("bp"), (F.min("l_discount") * 10).alias("rp"),
    )
    return on_plane(s, "id")


PLACED = f"SELECT *, sqrt(pow(x - 5000, 2) + pow(y - 4000, 2)) AS dist_center, least(x, y, 10000 - x, 8000 - y) AS dist_edge FROM ({SOURCES})"
STATS = "SELECT plate, CASE WHEN count(*) FILTER (inside) > 3 THEN avg(background) FILTER (inside) ELSE avg(background) END AS m, CASE WHEN count(*) FILTER (inside) > 3 THEN stddev_pop(background) FILTER (inside) ELSE stddev_pop(background) END AS s FROM (SELECT *, dist_edge > 400 AND dist_edge < 3600 AS inside FROM placed) GROUP BY plate"
SCORED = f"""WITH placed AS ({PLACED}), st AS ({STATS}),
    sc AS (SELECT p.*, abs(background - m) / nullif(s, 0) / greatest(least(x / 10000, 1 - x / 10000, y / 8000, 1 - y / 8000), 1e-5::DOUBLE) AS border FROM placed p JOIN st USING (plate))"""


def scored(spark, d):
    placed = detections.distances(sources(spark, d), WIDTH, HEIGHT)
    with_stats = placed.join(detections.background_stats(placed, "plate", HEIGHT / 2), "plate")
    return with_stats.withColumn("border", detections.border_score(with_stats, WIDTH, HEIGHT))


@query(
    "clean_flags",
    f"{SCORED} SELECT id, plate, round(border, 4) AS border, CASE WHEN flux_radius > 0 AND elongation < 5 AND magerr < 5 AND border < 100 THEN 1 ELSE 0 END AS flag_clean, CASE WHEN border >= 100 THEN 1 ELSE 0 END AS flag_rim, CASE WHEN flux_radius <= 0 THEN 1 ELSE 0 END AS flag_negradius FROM sc",
)
def clean_flags(spark, d):
    return scored(spark, d).withColumns(detections.flags()).select("id", "plate", F.round("border", 4).alias("border"), "flag_clean", "flag_rim", "flag_negradius")


@query("background_stats", f"WITH placed AS ({PLACED}) SELECT plate, round(m, 6) AS bg_mean, round(s, 6) AS bg_std FROM ({STATS})")
def background_stats(spark, d):
    return detections.background_stats(detections.distances(sources(spark, d), WIDTH, HEIGHT), "plate", HEIGHT / 2).select("plate", F.round("bg_mean", 6).alias("bg_mean"), F.round("bg_std", 6).alias("bg_std"))


@query(
    "annular_bins",
    f"""WITH placed AS ({PLACED}), l AS (SELECT sqrt(pow(i.range * 100 - 5000, 2) + pow(j.range * 100 - 4000, 2)) AS r FROM range(4, 96) i, range(4, 76) j),
    o AS (SELECT sqrt(10000.0::DOUBLE * 10000 + 8000 * 8000) * 5 / 12 AS outer_r), e AS (SELECT quantile_cont(r, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS q FROM l, o WHERE r <= outer_r)
    SELECT plate, b AS annular_bin, count(*) AS n FROM (SELECT plate, CASE WHEN dist_edge < 400 OR dist_center >= outer_r THEN 9 ELSE 1 + len(list_filter(q, lambda v: v <= dist_center)) END AS b FROM placed, o, e) GROUP BY plate, b""",
)
def annular_bins(spark, d):
    placed = detections.distances(sources(spark, d), WIDTH, HEIGHT)
    edges = detections.bin_edges(int(WIDTH), int(HEIGHT))
    return placed.groupBy("plate", detections.annular_bin(edges, WIDTH, HEIGHT).alias("annular_bin")).agg(F.count(F.lit(1)).alias("n"))


@query("radius_percentiles", f"SELECT plate, unnest(range(1, 8)) AS k, round(unnest(quantile_cont(dist_center, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])), 6) AS edge FROM ({PLACED}) GROUP BY plate")
def radius_percentiles(spark, d):
    q = detections.distances(sources(spark, d), WIDTH, HEIGHT).groupBy("plate").agg(F.percentile("dist_center", F.array(*(F.lit(0.125 * k) for k in range(1, 8)))).alias("q"))
    return q.select("plate", F.posexplode("q").alias("i", "e")).select("plate", (F.col("i") + 1).cast("long").alias("k"), F.round("e", 6).alias("edge"))


@query(
    "calib_star_selection",
    f"{SCORED} SELECT id, plate FROM (SELECT *, CASE WHEN flux_radius > 0 AND elongation < 5 AND magerr < 5 AND border < 100 THEN 1 ELSE 0 END AS clean FROM sc) WHERE plate % 5 <> 0 AND mag > 0 AND mag < 90 AND id % 3 IN (0, 2) AND clean = 1 AND bp - rp <= 2 AND id % 4 = 1",
)
def calib_star_selection(spark, d):
    s = scored(spark, d).withColumns(detections.flags()).withColumns({"solution_num": F.when(F.col("plate") % 5 != 0, 1), "phot_flag": F.col("id") % 3, "neighbours": F.when(F.col("id") % 4 == 1, 1).otherwise(2)})
    return s.filter(detections.calibration_stars()).select("id", "plate")


@query("colour_subset", f"WITH s AS (SELECT id, plate, id % 9 AS annular_bin FROM ({SOURCES})), w AS (SELECT *, count(*) FILTER (annular_bin <= 3) OVER (PARTITION BY plate) AS c FROM s) SELECT id, plate FROM w WHERE annular_bin <= 3 OR c < 280 AND annular_bin <= 6")
def colour_subset(spark, d):
    s = sources(spark, d).select("id", "plate", (F.col("id") % 9).alias("annular_bin"))
    return detections.colour_subset(s, "plate", enough=280).select("id", "plate")


@query("calib_flags", f"SELECT id, CASE WHEN id % 5 = 0 THEN 2 WHEN id % 3 = 0 THEN 1 ELSE 0 END AS phot_calib_flag FROM ({SOURCES})")
def calib_flags(spark, d):
    s = sources(spark, d).select("id")
    return detections.calibration_flags(s, s.filter("id % 3 = 0"), s.filter("id % 5 = 0"), "id")


@query("bright_topk_offset", f"SELECT id, round(mag, 6) AS mag FROM ({SOURCES}) WHERE flux_radius > 0 ORDER BY mag, id LIMIT 1000 OFFSET 10")
def bright_topk_offset(spark, d):
    return detections.brightest(sources(spark, d).filter("flux_radius > 0").select("id", "mag"), "mag", "id", 10, 1000).select("id", F.round("mag", 6).alias("mag"))


@query("nth_threshold", f"SELECT plate, round(background, 6) AS threshold FROM (SELECT plate, background, row_number() OVER (PARTITION BY plate ORDER BY background DESC, id) AS n FROM ({SOURCES})) WHERE n = 51")
def nth_threshold(spark, d):
    return detections.nth_largest(sources(spark, d), "plate", "background", 50, "id").select("plate", F.round("threshold", 6).alias("threshold"))


@query(
    "weighted_sigma",
    """WITH s AS (SELECT l_returnflag AS field, l_discount AS sigma1, l_tax + 0.01 AS sigma2, CAST(l_quantity AS BIGINT) AS ndeg FROM lineitem), g AS (SELECT field, sum(sigma1 * ndeg) / sum(ndeg) AS w1, sum(sigma2 * ndeg) / sum(ndeg) AS w2, sum(ndeg) AS total FROM s WHERE ndeg > 10 GROUP BY field)
    SELECT field, round(sqrt(w1 * w1 + w2 * w2), 6) AS sigma, CAST(total AS BIGINT) AS num_stars FROM g""",
)
def weighted_sigma(spark, d):
    s = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("field"), F.col("l_discount").alias("sigma1"), (F.col("l_tax") + 0.01).alias("sigma2"), F.col("l_quantity").cast("long").alias("ndeg"))
    return detections.match_tolerance(s, 0.001, ["field"]).select("field", F.round("sigma", 6).alias("sigma"), "num_stars")


@query("counts_per_solution", "SELECT s_suppkey, count(l_orderkey) AS n FROM supplier LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 48 AND l_suppkey % 2 = 0) ON l_suppkey = s_suppkey GROUP BY s_suppkey")
def counts_per_solution(spark, d):
    li = load(spark, d, "lineitem").filter("l_quantity > 48 AND l_suppkey % 2 = 0").select(F.col("l_suppkey").alias("s_suppkey"))
    return detections.counts_with_zeros(li, load(spark, d, "supplier"), "s_suppkey")


@query("weighted_epoch", "SELECT l_orderkey, round(sum(CAST(epoch_us(l_shipdate) AS DOUBLE) / 86400e6 * l_quantity) / sum(l_quantity) + 2440587.5, 4) AS jd_weighted FROM lineitem GROUP BY l_orderkey")
def weighted_epoch(spark, d):
    days = F.unix_micros(F.col("l_shipdate").cast("timestamp")).cast("double") / F.lit(86400e6)
    return load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(detections.weighted_mean(days, F.col("l_quantity")) + 2440587.5, 4).alias("jd_weighted"))


@query(
    "first_last_subexposure",
    "SELECT l_orderkey, min_by(l_shipdate, ROW(l_linenumber, l_shipdate)) AS first_start, max_by(l_shipdate, ROW(l_linenumber, l_shipdate)) AS last_start, count(*) AS num_sub, sum(l_quantity) AS exptime FROM lineitem GROUP BY l_orderkey",
)
def first_last_subexposure(spark, d):
    return detections.sub_exposure_sums(load(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_shipdate"], "l_shipdate", "l_quantity")


@query("earliest_year", "SELECT o_custkey, min(year(o_orderdate)) AS year_start FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey")
def earliest_year(spark, d):
    return load(spark, d, "orders").filter("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).cast("long").alias("year_start"))


@query("unique_keep_first", f"SELECT background, min(id) AS id FROM (SELECT round(background) AS background, id FROM ({SOURCES})) GROUP BY background")
def unique_keep_first(spark, d):
    return detections.unique_first(sources(spark, d).select(F.round("background").alias("background"), "id"), "background", "id")


@query("value_counts", "SELECT l_quantity AS label, count(*) AS n FROM lineitem GROUP BY l_quantity")
def value_counts(spark, d):
    return load(spark, d, "lineitem").groupBy(F.col("l_quantity").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("iqr_fence", "WITH q AS (SELECT p_brand, quantile_cont(p_retailprice, 0.25) AS a, quantile_cont(p_retailprice, 0.75) AS b FROM part GROUP BY p_brand) SELECT p_partkey, p.p_brand FROM part p JOIN q USING (p_brand) WHERE p_retailprice BETWEEN a - (b - a) * 0.2::DOUBLE AND b + (b - a) * 0.2::DOUBLE")
def iqr_fence(spark, d):
    return detections.inside_fences(load(spark, d, "part"), "p_brand", "p_retailprice", 0.2).select("p_partkey", "p_brand")


@query("midrange", "SELECT p_brand, (min(p_size) + max(p_size)) / 2.0::DOUBLE AS mid FROM part GROUP BY p_brand")
def midrange(spark, d):
    return load(spark, d, "part").groupBy("p_brand").agg(detections.midrange("p_size").alias("mid"))


@query("rms_errors", "SELECT l_returnflag, round(sqrt(avg(l_discount * l_discount)), 9) AS rms, round(sqrt(avg(pow(l_discount / nullif(l_quantity, 0), 2))) * sqrt(avg(l_quantity * l_quantity)), 6) AS weighted FROM lineitem GROUP BY l_returnflag")
def rms_errors(spark, d):
    a, b = F.col("l_discount"), F.col("l_quantity")
    return load(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(detections.rms(a), 9).alias("rms"), F.round(detections.weighted_rms(a, b), 6).alias("weighted"))


@query("conditional_counts", "SELECT l_suppkey, count(*) FILTER (l_discount > 0.09) AS num_true, count(*) FILTER (l_discount < 0.01) AS num_artifacts, arg_max(l_orderkey, ROW(l_extendedprice, l_orderkey)) AS brightest FROM lineitem GROUP BY l_suppkey")
def conditional_counts(spark, d):
    return load(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_discount") > 0.09).alias("num_true"), F.count_if(F.col("l_discount") < 0.01).alias("num_artifacts"), F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("brightest"))


@query(
    "moving_rms",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000 AS v, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
    m AS (SELECT o_orderkey, o_orderstatus, v, i AS pos, true AS own FROM o UNION ALL SELECT o_orderkey, o_orderstatus, v, 1 - i, false FROM o WHERE i <= 5 UNION ALL SELECT o_orderkey, o_orderstatus, v, 2 * n + 1 - i, false FROM o WHERE n - i < 4)
    SELECT o_orderkey, round(rms, 6) AS rms FROM (SELECT *, sqrt(avg(v * v) OVER (PARTITION BY o_orderstatus ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)) AS rms FROM m) WHERE own""",
)
def moving_rms(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 1000).alias("v"))
    return detections.moving_rms(o, "o_orderstatus", ["o_orderkey"], "v").select("o_orderkey", F.round("rms", 6).alias("rms"))


@query(
    "local_weights",
    "WITH p AS (SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS mag, p_retailprice / 100 AS v FROM part), s AS (SELECT a.p_partkey, count(*) AS n, var_pop(b.v) AS var FROM p a JOIN p b ON a.p_brand = b.p_brand AND abs(a.mag - b.mag) < 2 GROUP BY a.p_partkey) SELECT p_partkey, round(CASE WHEN n > 2 THEN 1 / var END, 4) AS weight FROM s",
)
def local_weights(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("mag"), (F.col("p_retailprice") / 100).alias("v"))
    return detections.local_weights(p, "p_brand", "mag", "v", 2.0).select("p_partkey", F.round("weight", 4).alias("weight"))


@query("linear_blend", "SELECT o_orderkey, least((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1) / 200.0::DOUBLE, 1) AS blend FROM orders")
def linear_blend(spark, d):
    return detections.blend_weights(load(spark, d, "orders"), "o_orderstatus", ["o_totalprice", "o_orderkey"], 200).select("o_orderkey", "blend")


@query("brightest_share", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE i <= greatest(least(floor(n * 0.02::DOUBLE), 2000), 5)")
def brightest_share(spark, d):
    return detections.brightest_share(load(spark, d, "orders"), "o_orderpriority", "o_totalprice", "o_orderkey").select("o_orderkey")


@query("exposure_joins", "SELECT s_nationkey AS plate, count(*) AS pairs FROM (SELECT a.s_nationkey, a.s_suppkey, b.s_suppkey AS other FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey) GROUP BY s_nationkey")
def exposure_joins(spark, d):
    s = load(spark, d, "supplier").select("s_nationkey", "s_suppkey")
    return s.join(s.select("s_nationkey", F.col("s_suppkey").alias("other")), "s_nationkey").filter("s_suppkey < other").groupBy(F.col("s_nationkey").alias("plate")).agg(F.count(F.lit(1)).alias("pairs"))


# Records


@query("jd_and_year", "SELECT event_id, round(CAST(epoch_us(ts) AS DOUBLE) / 86400e6 + 2440587.5, 5) AS jd, round(2000.0::DOUBLE + (CAST(epoch_us(ts) AS DOUBLE) / 86400e6 + 2440587.5 - 2451545.0) / 365.25, 8) AS year FROM events")
def jd_and_year(spark, d):
    ts = F.col("ts").cast("timestamp")
    return load(spark, d, "events").select("event_id", times.julian_date(ts).alias("jd"), times.julian_year(ts).alias("year"))


@query("tz_to_utc", "SELECT event_id, epoch_us(timezone('Europe/Berlin', ts)) AS utc FROM events")
def tz_to_utc(spark, d):
    return load(spark, d, "events").select("event_id", F.unix_micros(times.to_utc(F.col("ts").cast("timestamp"), "Europe/Berlin")).alias("utc"))


@query(
    "end_and_mid_time",
    "WITH e AS (SELECT event_id, ts AS s, CASE WHEN event_id % 3 > 0 THEN ts + to_seconds(CAST(event_id % 7 * 3600 AS BIGINT)) - to_seconds(7200) END AS e0 FROM events), f AS (SELECT event_id, s, CASE WHEN e0 < s THEN e0 + INTERVAL 1 DAY ELSE e0 END AS e FROM e) SELECT event_id, epoch_us(e) AS ut_end, CAST(floor(CASE WHEN e IS NOT NULL THEN (epoch_us(s) + epoch_us(e)) / 2 ELSE epoch_us(s) + 600 * 5e5 END) AS BIGINT) AS ut_mid FROM f",
)
def end_and_mid_time(spark, d):
    start = F.col("ts").cast("timestamp")
    end = F.when(F.col("event_id") % 3 > 0, F.timestamp_micros(F.unix_micros(start) + (F.col("event_id") % 7 * 3600 - 7200) * 1_000_000))
    fixed = times.end_after_start(start, end)
    return load(spark, d, "events").select("event_id", F.unix_micros(fixed).alias("ut_end"), F.unix_micros(times.mid_time(start, fixed, F.lit(600.0))).alias("ut_mid"))


@query("clock_text", "SELECT DISTINCT o_orderkey % 30 AS h, printf('%02d:%02d:%02d', o_orderkey % 30, o_orderkey % 60, 0) AS time, CAST((o_orderkey % 30) * 3600 + (o_orderkey % 60) * 60 AS DOUBLE) AS seconds FROM orders")
def clock_text(spark, d):
    t = F.concat((F.col("o_orderkey") % 30).cast("string"), F.lit(":"), (F.col("o_orderkey") % 60).cast("string"), F.lit(":"))
    s = times.seconds_of(t)
    return load(spark, d, "orders").select((F.col("o_orderkey") % 30).alias("h"), times.time_text(s).alias("time"), s.alias("seconds")).distinct()


@query("duration", "SELECT o_orderkey, epoch_us(max(l_shipdate)) // 1000000 - epoch_us(any_value(o_orderdate)) // 1000000 AS seconds FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def duration(spark, d):
    last = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("end"))
    return load(spark, d, "orders").join(last, "o_orderkey").select("o_orderkey", records.duration_seconds(F.col("o_orderdate").cast("timestamp"), F.col("end").cast("timestamp")).alias("seconds"))


NOTES = "'Object: ' || c_name || '; focus: ' || c_nationkey || '; exposure time: ' || c_custkey || '; stray ' || c_mktsegment || '; Colour: red'"


@query("notes_kv_parse", f"SELECT c_custkey, c_name AS object, CAST(c_nationkey AS DOUBLE) AS focus, CAST(c_custkey AS DOUBLE) AS exptime, 'stray ' || c_mktsegment || '; colour: red' AS notes FROM customer")
def notes_kv_parse(spark, d):
    kv = text.key_values(F.expr(NOTES))
    c = load(spark, d, "customer").select("c_custkey", kv.alias("kv"))
    known = ("object", "focus", "exposure time")
    return c.select("c_custkey", text.value_of(F.col("kv"), "object").alias("object"), text.number(text.value_of(F.col("kv"), "focus")).alias("focus"), text.number(text.value_of(F.col("kv"), "exposure time")).alias("exptime"), text.joined_values(F.col("kv"), "notes", known).alias("notes"))


@query("time_prefix_split", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) || ':10' END AS civil, CAST(c_nationkey AS VARCHAR) || ':20' AS ut, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) || ':30' END AS st FROM customer")
def time_prefix_split(spark, d):
    n = F.col("c_nationkey").cast("string")
    field = F.concat_ws(", ", F.when(F.col("c_custkey") % 2 == 0, F.concat(n, F.lit(":10"))), F.lit("UT 1:00"), F.concat(F.lit("UT "), n, F.lit(":20")), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("ST "), n, F.lit(":30"))))
    return load(spark, d, "customer").select("c_custkey", text.tagged_times(field).alias("t")).select("c_custkey", "t.*")


@query("ascii_fold", "SELECT doc_id, md5(regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '[^\\x00-\\x7F]', '?', 'g')) AS folded FROM documents")
def ascii_fold(spark, d):
    return load(spark, d, "documents").select("doc_id", F.md5(text.ascii_folded(F.col("text"))).alias("folded"))


@query("list_split", "SELECT p_partkey, len(list_filter(string_split(p_type || ';' || p_name || '; ' || p_size, ';'), lambda x: true)) AS n, trim(string_split(p_type || ';' || p_name || '; ' || p_size, ';')[3]) AS last, CAST(p_size AS DOUBLE) AS number FROM part")
def list_split(spark, d):
    parts = text.items(F.concat(F.col("p_type"), F.lit(";"), F.col("p_name"), F.lit("; "), F.col("p_size").cast("string")))
    return load(spark, d, "part").select("p_partkey", parts.alias("i")).select("p_partkey", F.size("i").cast("long").alias("n"), F.try_element_at("i", F.lit(-1)).alias("last"), text.number(F.try_element_at("i", F.lit(-1))).alias("number"))


@query("code_lookup", "SELECT p_partkey, m.method FROM part LEFT JOIN (VALUES " + ", ".join("({}, '{}')".format(k, v.replace("'", "''")) for k, v in text.METHODS.items()) + ") m(code, method) ON p_size = code")
def code_lookup(spark, d):
    return load(spark, d, "part").select("p_partkey", text.lookup(F.col("p_size"), text.METHODS).alias("method"))


@query("formatted_ids", "SELECT p_partkey, printf('%04d-%05d-%1d', p_partkey % 9538, p_size, 1) AS tycho, CASE WHEN p_partkey % 2 = 0 THEN 'JPEG' ELSE 'TIFF' END AS format FROM part")
def formatted_ids(spark, d):
    name = F.when(F.col("p_partkey") % 2 == 0, "a.b.jpg").otherwise("x.TIF")
    return load(spark, d, "part").select("p_partkey", text.padded_id((F.col("p_partkey") % 9538, 4), (F.col("p_size"), 5), (F.lit(1), 1)).alias("tycho"), text.file_format(name).alias("format"))


@query("sexagesimal", "SELECT p_partkey, round(sign * (p_size + 30 / 60.0::DOUBLE + 15.5 / 3600.0::DOUBLE), 8) AS degrees FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END AS sign FROM part)")
def sexagesimal(spark, d):
    t = F.concat(F.when(F.col("p_partkey") % 2 == 0, "-").otherwise(""), F.col("p_size").cast("string"), F.lit(":30:15.5"))
    return load(spark, d, "part").select("p_partkey", F.round(sky.sexagesimal(t), 8).alias("degrees"))


@query("composite_key", "SELECT (4 * 1000000::BIGINT + l_suppkey) * 10000000 + l_orderkey * 8 + l_linenumber AS source_id, count(*) AS n FROM lineitem GROUP BY 1")
def composite_key(spark, d):
    return load(spark, d, "lineitem").groupBy(records.source_key(F.lit(4), F.col("l_suppkey"), F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("source_id")).agg(F.count(F.lit(1)).alias("n"))


@query("schema_project_nullify", "SELECT p_partkey AS source_id, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_retailprice END AS mag, CASE WHEN p_size >= 10 THEN p_size END AS healpix256, nullif(CAST(p_partkey % 5 AS BIGINT), 0) AS gaiaedr3_id, CAST(NULL AS DOUBLE) AS missing FROM part")
def schema_project_nullify(spark, d):
    p = load(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("source_id"), F.when(F.col("p_partkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("mag"), F.when(F.col("p_size") >= 10, F.col("p_size")).otherwise(-1).alias("healpix256"), (F.col("p_partkey") % 5).alias("gaiaedr3_id"), F.lit("x").alias("unknown"))
    schema = T.StructType([T.StructField("source_id", T.LongType()), T.StructField("mag", T.DoubleType()), T.StructField("healpix256", T.IntegerType()), T.StructField("gaiaedr3_id", T.LongType()), T.StructField("missing", T.DoubleType())])
    return records.projected(records.nullified(rows, {"gaiaedr3_id": 0}, ("healpix256",)), schema, fill=True)


@query(
    "id_resolution_cascade",
    """WITH plates AS (SELECT c_custkey AS plate_id, c_nationkey AS archive_id, CAST(c_custkey % 60 AS VARCHAR) AS plate_num, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS wfpdb_id FROM customer WHERE c_custkey > 0),
    scans AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE 0 END AS plate_id, CAST(o_orderkey % 25 AS INT) AS archive_id, CAST(o_orderkey % 60 AS VARCHAR) AS plate_num, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS wfpdb_id FROM orders)
    SELECT o_orderkey, coalesce(CASE WHEN s.plate_id > 0 THEN s.plate_id END, a.p, w.p) AS plate_id FROM scans s LEFT JOIN (SELECT archive_id, plate_num, min(plate_id) AS p FROM plates GROUP BY ALL) a USING (archive_id, plate_num) LEFT JOIN (SELECT wfpdb_id, min(plate_id) AS p FROM plates WHERE wfpdb_id IS NOT NULL GROUP BY ALL) w USING (wfpdb_id)""",
)
def id_resolution_cascade(spark, d):
    c, o = load(spark, d, "customer"), load(spark, d, "orders")
    plates = c.filter("c_custkey > 0").select(F.col("c_custkey").alias("plate_id"), F.col("c_nationkey").alias("archive_id"), (F.col("c_custkey") % 60).cast("string").alias("plate_num"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("wfpdb_id"))
    scans = o.select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey")).otherwise(0).alias("plate_id"), (F.col("o_orderkey") % 25).cast("int").alias("archive_id"), (F.col("o_orderkey") % 60).cast("string").alias("plate_num"), F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("wfpdb_id"))
    return records.resolved_ids(scans, plates).select("o_orderkey", "plate_id")


@query(
    "metadata_precedence",
    "SELECT c_custkey AS plate, coalesce(CASE WHEN s_acctbal > 5000 THEN s_name END, n_name, c_name) AS observer, coalesce(s_acctbal, c_acctbal) AS exptime FROM customer LEFT JOIN nation ON n_nationkey = c_custkey LEFT JOIN supplier ON s_suppkey = c_custkey",
)
def metadata_precedence(spark, d):
    base = load(spark, d, "customer").select(F.col("c_custkey").alias("plate"), F.col("c_name").alias("observer"), F.col("c_acctbal").alias("exptime"))
    second = load(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("plate"), F.col("n_name").alias("observer"))
    third = load(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("plate"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("observer"), F.col("s_acctbal").alias("exptime"))
    return records.merged("plate", base, second, third)


@query("last_row_wins", "SELECT l_orderkey, max_by(l_quantity, ROW(l_linenumber, l_shipdate, l_extendedprice, l_quantity)) AS quantity FROM lineitem GROUP BY l_orderkey")
def last_row_wins(spark, d):
    li = load(spark, d, "lineitem").withColumn("pos", F.struct("l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity")).select("l_orderkey", F.col("l_quantity").alias("quantity"), "pos")
    return records.last_wins(li, "l_orderkey", "pos").select("l_orderkey", "quantity")


@query("fill_if_empty", "SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN n_name WHEN c_custkey % 3 = 1 THEN n_name ELSE c_name END AS observer FROM customer JOIN nation ON n_nationkey = c_custkey % 25")
def fill_if_empty(spark, d):
    c = load(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 2, F.col("c_name")).alias("observer"), (F.col("c_custkey") % 25).cast("int").alias("n_nationkey"))
    source = rows.select("key", "n_nationkey").join(load(spark, d, "nation"), "n_nationkey").select("key", F.col("n_name").alias("observer"))
    return records.filled_from(rows.drop("n_nationkey"), source, "key", ["observer"])


@query("exposure_values", "SELECT c_custkey AS plate_id, e.range + 1 AS exposure_num, CASE WHEN c_nationkey % 3 = 0 OR e.range = 0 THEN c_acctbal + CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE e.range END END AS exptime FROM customer, range(0, 3) e WHERE e.range < 1 + c_custkey % 3")
def exposure_values(spark, d):
    v = F.when(F.col("c_nationkey") % 3 == 0, F.array("c_acctbal")).otherwise(F.array(F.col("c_acctbal"), F.lit(None).cast("double")))
    plates = load(spark, d, "customer").select(F.col("c_custkey").alias("plate_id"), (F.col("c_custkey") % 3 + 1).cast("int").alias("numexp"), v.alias("exptime"))
    return records.exposures(plates, "plate_id", ["exptime"]).withColumn("exposure_num", F.col("exposure_num").cast("long"))


@query("sub_exposure_split", "SELECT p_partkey, i.range + 1 AS subexposure_num, string_split(p_size || ':00|' || p_size || ':30', '|')[i.range + 1] AS start FROM part, range(0, 2) i")
def sub_exposure_split(spark, d):
    p = load(spark, d, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit(":00|"), F.col("p_size").cast("string"), F.lit(":30")).alias("start"))
    return records.sub_exposures(p, ["p_partkey"], "start").withColumn("subexposure_num", F.col("subexposure_num").cast("long"))


@query("page_links", "SELECT o_custkey AS plate_id, CAST(substr(name, 2) AS BIGINT) AS logpage_id, pos AS logpage_order FROM (SELECT o_custkey, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM (SELECT o_custkey, list('p' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END ORDER BY o_orderkey) AS names FROM orders GROUP BY o_custkey)) WHERE name <> 'p' AND CAST(substr(name, 2) AS BIGINT) % 3 <> 0")
def page_links(spark, d):
    o = load(spark, d, "orders")
    named = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")))
    plates = o.groupBy(F.col("o_custkey").alias("plate_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", named.alias("n")))), lambda x: x["n"]).alias("logpages"))
    pages = o.filter("o_orderkey % 3 <> 0").select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("filename"), F.col("o_orderkey").alias("logpage_id"))
    return records.page_links(plates, pages).withColumn("logpage_order", F.col("logpage_order").cast("long"))


@query("latest_process_state", "SELECT user_id, max_by(CASE WHEN event_type <> 'click' THEN value END, ROW(ts, event_id)) FILTER (event_type <> 'click') AS value, max_by(event_type, ROW(ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_process_state(spark, d):
    e = load(spark, d, "events").withColumn("value", F.when(F.col("event_type") != "click", F.col("value")))
    return records.latest_state(e, "user_id", ["ts", "event_id"], ["value", "event_type"])


@query("update_by_key", "SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS c_acctbal FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def update_by_key(spark, d):
    changes = load(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return records.updated(load(spark, d, "customer").select("c_custkey", "c_acctbal"), changes, "c_custkey")


# Fits


@query("linear_fit", "SELECT p_brand, round(regr_slope(p_retailprice, p_size), 6) AS slope, round(regr_intercept(p_retailprice, p_size), 4) AS intercept FROM part GROUP BY p_brand")
def linear_fit(spark, d):
    f = fits.line("p_size", "p_retailprice")
    return load(spark, d, "part").groupBy("p_brand").agg(F.round(f["slope"], 6).alias("slope"), F.round(f["intercept"], 4).alias("intercept"))


def _fit_sql(x: list[str], y: str, group: str, table: str, names: list[str]) -> str:
    sums = ", ".join([f"sum(({x[i]}) * ({x[j]})) AS m{i}{j}" for i in range(3) for j in range(i, 3)] + [f"sum(({x[i]}) * {y}) AS r{i}" for i in range(3)])
    m = [[f"m{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    det = lambda q: f"({q[0][0]} * ({q[1][1]} * {q[2][2]} - {q[1][2]} * {q[2][1]}) - {q[0][1]} * ({q[1][0]} * {q[2][2]} - {q[1][2]} * {q[2][0]}) + {q[0][2]} * ({q[1][0]} * {q[2][1]} - {q[1][1]} * {q[2][0]}))"
    swap = lambda k: [[f"r{i}" if j == k else m[i][j] for j in range(3)] for i in range(3)]
    return f"SELECT {group}, " + ", ".join(f"round({det(swap(k))} / {det(m)}, 3) AS {n}" for k, n in enumerate(names)) + f" FROM (SELECT {group}, {sums} FROM {table} GROUP BY {group})"


@query("polyfit2_normal_eq", _fit_sql(["u * u", "u", "1.0::DOUBLE"], "p_retailprice", "p_brand", "(SELECT p_brand, p_retailprice, p_size / 10.0::DOUBLE AS u FROM part)", ["a", "b", "c"]))
def polyfit2_normal_eq(spark, d):
    p = load(spark, d, "part").withColumn("u", F.col("p_size") / 10.0)
    return fits.quadratic(p, ["p_brand"], "u", "p_retailprice").select("p_brand", *(F.round(c, 3).alias(c) for c in "abc"))


@query("plane_fit", _fit_sql(["u", "v", "1.0::DOUBLE"], "p_retailprice", "p_brand", "(SELECT p_brand, p_retailprice, p_size / 10.0::DOUBLE AS u, (p_partkey * 7919 % 1000) / 100.0::DOUBLE AS v FROM part)", ["a", "b", "c"]))
def plane_fit(spark, d):
    p = load(spark, d, "part").withColumns({"u": F.col("p_size") / 10.0, "v": (F.col("p_partkey") * 7919 % 1000) / 100.0})
    return fits.plane(p, ["p_brand"], "u", "v", "p_retailprice").select("p_brand", *(F.round(c, 3).alias(c) for c in "abc"))


@query(
    "scale_rotation",
    "SELECT label, round(sqrt((var_pop(embedding[3]::DOUBLE) + var_pop(embedding[4]::DOUBLE)) / (var_pop(embedding[1]::DOUBLE) + var_pop(embedding[2]::DOUBLE))), 6) AS scale, round(degrees(atan2(covar_pop(embedding[1]::DOUBLE, embedding[4]::DOUBLE) - covar_pop(embedding[2]::DOUBLE, embedding[3]::DOUBLE), covar_pop(embedding[1]::DOUBLE, embedding[3]::DOUBLE) + covar_pop(embedding[2]::DOUBLE, embedding[4]::DOUBLE))), 4) AS rotation FROM embeddings GROUP BY label",
)
def scale_rotation(spark, d):
    e = load(spark, d, "embeddings").select("label", *(F.get("embedding", F.lit(k)).cast("double").alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))))
    return fits.scale_rotation(e, ["label"], "x1", "y1", "x2", "y2").select("label", F.round("scale", 6).alias("scale"), F.round("rotation", 4).alias("rotation"))


def _clip_sql(rounds: int, sigma: float = 1.5) -> str:
    out = "(SELECT p_brand, p_partkey, p_retailprice FROM part)"
    for _ in range(rounds):
        out = f"(SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, median(p_retailprice) OVER w AS mid, stddev_pop(p_retailprice) OVER w AS dev FROM {out} WINDOW w AS (PARTITION BY p_brand)) WHERE abs(p_retailprice - mid) <= dev * {sigma}::DOUBLE)"
    return f"SELECT p_brand, p_partkey FROM {out}"


@query("sigma_clip_fixed3", _clip_sql(3))
def sigma_clip_fixed3(spark, d):
    return fits.sigma_clipped(load(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], "p_retailprice", 1.5, 3).select("p_brand", "p_partkey")


STABLE_SQL = """WITH RECURSIVE c(n, p_brand, p_partkey, p_retailprice) AS (SELECT 0, p_brand, p_partkey, p_retailprice FROM part UNION ALL
    SELECT n + 1, p_brand, p_partkey, p_retailprice FROM (SELECT *, count(*) FILTER (NOT kept) OVER () AS gone FROM (SELECT *, abs(p_retailprice - median(p_retailprice) OVER w) <= stddev_pop(p_retailprice) OVER w * 1.9::DOUBLE AS kept FROM c WINDOW w AS (PARTITION BY p_brand))) WHERE gone > 0 AND kept)
    SELECT p_brand, p_partkey FROM c WHERE n = (SELECT max(n) FROM c)"""


@query("sigma_clip_until_stable", STABLE_SQL)
def sigma_clip_until_stable(spark, d):
    return fits.sigma_clipped(load(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], "p_retailprice", 1.9, None).select("p_brand", "p_partkey")


KDE = "WITH n AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag), k AS (SELECT l_returnflag, 0.0::DOUBLE + g.range * 1.0::DOUBLE AS grid, sum(exp(-pow((g.range * 1.0::DOUBLE - l_quantity) / 0.8::DOUBLE, 2) / 2)) AS s FROM lineitem, range(0, 60) g WHERE abs(g.range - l_quantity) <= 4 GROUP BY ALL), d AS (SELECT l_returnflag, grid, s / (n * 0.8::DOUBLE * sqrt(2 * pi())) AS density FROM k JOIN n USING (l_returnflag))"


@query("kde_grid", f"{KDE} SELECT l_returnflag, grid, round(density, 9) AS density FROM d")
def kde_grid(spark, d):
    return fits.density_grid(load(spark, d, "lineitem"), "l_returnflag", "l_quantity", 0.0, 1.0, 60, 0.8).withColumn("density", F.round("density", 9))


@query("kde_support", f"{KDE} SELECT l_returnflag, max_by(grid, ROW(round(density, 9), -grid)) AS mode, min(grid) FILTER (density > top * 0.2::DOUBLE) AS low, max(grid) FILTER (density > top * 0.2::DOUBLE) AS high FROM (SELECT *, max(density) OVER (PARTITION BY l_returnflag) AS top FROM d) GROUP BY l_returnflag")
def kde_support(spark, d):
    g = fits.density_grid(load(spark, d, "lineitem"), "l_returnflag", "l_quantity", 0.0, 1.0, 60, 0.8)
    return fits.density_support(g.withColumn("density", F.round("density", 9)), "l_returnflag")


CURVE = "WITH c AS (SELECT p_brand, CAST(p_size AS DOUBLE) AS cx, avg(p_retailprice) AS cy FROM part WHERE p_size % 10 = 5 GROUP BY ALL), s AS (SELECT p_brand, cx AS x0, cy AS y0, lead(cx) OVER w AS x1, lead(cy) OVER w AS y1, row_number() OVER w AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM c WINDOW w AS (PARTITION BY p_brand ORDER BY cx))"


@query("curve_interpolation", f"{CURVE} SELECT p_partkey, round(y0 + (p_size - x0) * (y1 - y0) / (x1 - x0), 6) AS value FROM part p LEFT JOIN s ON p.p_brand = s.p_brand AND k < n AND (p_size >= x0 OR k = 1) AND (p_size < x1 OR k = n - 1)")
def curve_interpolation(spark, d):
    p = load(spark, d, "part")
    curve = p.filter("p_size % 10 = 5").groupBy("p_brand", F.col("p_size").cast("double").alias("cx")).agg(F.avg("p_retailprice").alias("cy"))
    return fits.interpolated(p.select("p_brand", "p_partkey", "p_size"), curve, "p_brand", "p_size").select("p_partkey", F.round("value", 6).alias("value"))


@query("lowess_curve")
def lowess_curve(spark, d):
    s = sources(spark, d).select("plate", "id", "mag", "background")
    return fits.lowess_curves(s, "plate", "mag", "background", "id")


@query("dbscan_labels")
def dbscan_labels(spark, d):
    p = on_plane(load(spark, d, "part"), "p_partkey").select(F.col("p_partkey").alias("id"), "x", "y")
    return fits.dbscan_labels(p, "id", 150.0, 3)


@query("color_term_scan")
def color_term_scan(spark, d):
    s = sources(spark, d).select((F.col("plate") % 4).alias("plate"), "id", "mag", "bp", "rp")
    return photometry.colour_terms(s, ["plate"])


@query("solution_calibration")
def solution_calibration(spark, d):
    """The whole chain on each plate's stars, whose natural magnitudes follow the plate's by a colour term of 0.5."""
    s = on_plane(sources(spark, d).withColumn("plate", F.col("plate") % 4), "id")
    colour, noise = (F.col("id") % 97) / 97, (F.col("id") * 31 % 13) / 100
    stars = s.select("plate", "id", "mag", (F.col("mag") + 0.5 * colour + noise).alias("bp"), (F.col("mag") - 0.5 * colour + noise).alias("rp"), "x", "y")
    return photometry.calibrated_solutions(stars, ["plate"])
