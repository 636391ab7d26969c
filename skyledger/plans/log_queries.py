"""Process log windows, calibration, and time chains on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import calibration, fits, headers, plates
from skyledger.plans.binding import load
from skyledger.plans.plate_queries import SOURCES, sources
from skyledger.plans.registry import query
from skyledger.sources import store
from skyledger.streaming import log


def events(spark, d):
    return load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _micros(df, c):
    return df.withColumn(c, F.unix_micros(c)).withColumn("total", F.round("total", 4)) if "total" in df.columns else df.withColumn(c, F.unix_micros(c))


@query("log_event_counts", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS processes FROM events GROUP BY event_type")
def log_event_counts(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("processes"))


@query("tumbling_log_counts", "SELECT epoch_us(ts) // 300000000 * 300000000 AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_log_counts(spark, d):
    return _micros(log.window_counts(events(spark, d), "ts", ["event_type"], "5 minutes"), "window_start")


@query("sliding_log_counts", "SELECT epoch_us(ts) // 300000000 * 300000000 - k.range * 300000000 AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, range(0, 2) k GROUP BY ALL")
def sliding_log_counts(spark, d):
    return _micros(log.window_counts(events(spark, d), "ts", ["event_type"], "10 minutes", "5 minutes"), "window_start")


@query(
    "session_log_counts",
    "WITH s AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= 1800000000 THEN 1 ELSE 0 END AS fresh FROM events), g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT epoch_us(min(ts)) AS session_start, user_id, count(*) AS n FROM g GROUP BY user_id, k",
)
def session_log_counts(spark, d):
    return _micros(log.session_counts(events(spark, d), "ts", ["user_id"], "30 minutes"), "session_start")


@query("unseen_rows", "SELECT DISTINCT user_id FROM events")
def unseen_rows(spark, d):
    return log.unseen(events(spark, d).select("user_id", "ts"), "user_id", "ts").select("user_id")


@query(
    "exposure_times",
    """WITH p AS (SELECT o_orderkey, o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS s, o_orderdate + to_seconds(CAST((o_orderkey % 86400 + 7200) % 86400 AS BIGINT)) AS e0 FROM orders), q AS (SELECT o_orderkey, s, CASE WHEN e0 < s THEN e0 + INTERVAL 1 DAY ELSE e0 END AS e FROM p)
    SELECT o_orderkey AS plate_id, epoch_us(s) AS ut_start, epoch_us(e) AS ut_end, CAST((epoch_us(e) - epoch_us(s)) / 1e6 AS DOUBLE) AS exptime FROM q""",
)
def exposure_times(spark, d):
    clock = lambda s: F.concat(F.lit("UT "), F.concat_ws(":", *(F.lpad(v.cast("string"), 2, "0") for v in (F.floor(s / 3600), F.floor(s / 60) % 60, s % 60))))
    at = F.col("o_orderkey") % 86400
    rows = load(spark, d, "orders").select(F.col("o_orderkey").alias("plate_id"), F.array(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_orig"), F.array(clock(at)).alias("tms_orig"), F.array(clock((at + 7200) % 86400)).alias("tme_orig"), F.array().cast("array<double>").alias("exptime"), F.lit(1).alias("numexp"), F.lit("").alias("tz_orig"), F.lit(13.06417).alias("site_longitude"))
    out = plates.exposures_of(plates.exposure_parts(rows))
    return out.select("plate_id", F.unix_micros("ut_start").alias("ut_start"), F.unix_micros("ut_end").alias("ut_end"), "exptime")


@query("header_cards", "SELECT c_custkey, 'TELESCOP=' || c_mktsegment || ',OBSERVER=' || c_name || ',EXPTIME1=' || (c_nationkey * 10) || ',EXPTIME2=' || (c_nationkey * 20) || ',SITE=Potsdam' AS cards FROM customer")
def header_cards(spark, d):
    c = load(spark, d, "customer")
    base = F.array(headers.card("OBSERVER", F.lit("nobody")), headers.card("EXPTIME", F.lit("1")), headers.card("TELE", F.col("c_mktsegment")))
    cards = headers.updated_list(headers.updated(headers.renamed(headers.numbered(base), {"TELE": "TELESCOP"}), "OBSERVER", F.col("c_name")), "EXPTIME", F.array(F.col("c_nationkey") * 10, F.col("c_nationkey") * 20))
    cards = headers.reordered(headers.assigned(cards, {"SITE": "Potsdam"}), ["TELESCOP", "OBSERVER", "EXPTIME", "SITE"])
    return c.select("c_custkey", F.array_join(F.transform(cards, lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("cards"))


@query("formatted_rows", "SELECT printf('%06d', p_partkey) AS source_id, printf('%.3f', p_retailprice) AS mag, p_brand AS name FROM part")
def formatted_rows(spark, d):
    p = load(spark, d, "part").select(F.col("p_partkey").alias("source_id"), F.col("p_retailprice").alias("mag"), F.col("p_brand").alias("name"))
    return store.formatted(p, {"source_id": "%06d", "mag": "%.3f", "name": "%s"})


@query("surrogate_keys", "SELECT c_name, row_number() OVER (ORDER BY c_name) + 99 AS plate_id FROM customer")
def surrogate_keys(spark, d):
    return store.surrogate(load(spark, d, "customer").select("c_name"), "plate_id", ["c_name"], 100)


def _stars(spark, d):
    return sources(spark, d).select((F.col("plate") % 8).alias("plate"), "id", "x", (F.col("background") / 4).alias("mag"), "magerr", (F.col("background") / 4 * 0.9 + 2 + (F.col("id") % 17 - 8) / 40).alias("natmag"), (F.col("bp") - F.col("rp")).alias("color"))


@query("calibration_curves")
def calibration_curves(spark, d):
    return calibration.calibration_curves(_stars(spark, d), ["plate"])


@query("calibration_applied")
def calibration_applied(spark, d):
    s = _stars(spark, d)
    curves = calibration.calibration_curves(s, ["plate"])
    rows = s.drop("natmag").withColumns({"color_term": F.lit(0.4), "natmag_correction": F.lit(0.0)})
    return calibration.applied(rows, curves, "plate").select("id", "plate", "natmag", "natmag_error", "rpmag", "bpmag", "phot_range_flag")


@query("scanner_pattern")
def scanner_pattern(spark, d):
    return calibration.scanner_pattern(_stars(spark, d).withColumn("residual", F.sin(F.col("x") / 500.0) + (F.col("id") % 13) / 13.0), "plate", "x", "residual", 10000.0, "id")


@query("residual_plane", f"SELECT plate, round(regr_slope(v, x), 6) AS slope FROM (SELECT plate % 8 AS plate, x, x * 0.001::DOUBLE + id % 3 AS v FROM ({SOURCES})) GROUP BY plate")
def residual_plane(spark, d):
    rows = sources(spark, d).select((F.col("plate") % 8).alias("plate"), "x", (F.col("x") * 0.001 + F.col("id") % 3).alias("v"))
    return rows.groupBy("plate").agg(F.round(fits.line("x", "v")["slope"], 6).alias("slope"))
