"""Observation times of plates: exposures and their parts, from civil, universal or sidereal times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import times
from skyledger.operators.records import exposure_value


def _instant(text: Column, date: Column, zone: Column, longitude: Column) -> Column:
    """UT of one time text: 'UT h:m:s', 'ST h:m:s' or plain in the plate's zone; hours of 24 or more roll the date."""
    tag = F.upper(F.substring(F.trim(text), 1, 2))
    tagged = tag.isin("UT", "ST")
    kind = F.when(tagged, tag).otherwise(F.coalesce(zone, F.lit("UT")))
    seconds = times.seconds_of(F.when(tagged, F.substr(F.trim(text), F.lit(3))).otherwise(text))
    civil = times.at_time(date, seconds)
    named = F.when(F.upper(kind).isin("UT", "UTC", "ST"), "UTC").otherwise(kind)
    return F.when(kind == "ST", times.sidereal_to_ut(date, seconds, longitude)).otherwise(F.to_utc_timestamp(civil, named))


def exposure_parts(plates: DataFrame, key: str = "plate_id") -> DataFrame:
    """A row for each part of each exposure: exposure_num, subexposure_num, ut_start, ut_end, exptime, ut_mid.

    plates: key, date_orig, tms_orig, tme_orig (arrays of text), exptime (array of double), numexp, tz_orig, site_longitude. A
    date or an exposure time serves for all exposures if there is only one; times don't.
    """
    n = times.reconciled_count(F.col("numexp").cast("int"), F.col("tms_orig"), F.col("tme_orig"))
    each = plates.withColumn("_n", F.explode(F.sequence(F.lit(0), n - 1)))
    i = F.col("_n")
    empty = F.array().cast("array<string>")
    one = each.select(
        key, (i + 1).alias("exposure_num"), exposure_value(F.coalesce("date_orig", empty), i).alias("_date"), exposure_value(F.coalesce("tms_orig", empty), i, True).alias("_s"), exposure_value(F.coalesce("tme_orig", empty), i, True).alias("_e"),
        exposure_value(F.coalesce("exptime", F.array().cast("array<double>")), i).alias("_exp"), F.nullif(F.col("tz_orig"), F.lit("")).alias("_zone"), F.col("site_longitude").cast("double").alias("_lon"),
    )
    starts, ends = F.split(F.coalesce("_s", F.lit("")), r"\|"), F.split(F.coalesce("_e", F.lit("")), r"\|")
    parts = one.withColumns({"_ends": ends, "_count": F.size(starts)}).select("*", F.posexplode(starts).alias("_p", "_start"))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    date = F.try_to_date("_date", "yyyy-MM-dd")
    # One lambda over both texts: the conversion stands in the plan once, however often its result is used.
    both = F.transform(F.array(blank(F.col("_start")), blank(F.get("_ends", F.col("_p")))), lambda t: _instant(t, date, F.col("_zone"), F.col("_lon")))
    timed = parts.withColumn("_both", both).withColumns({"ut_start": F.get("_both", F.lit(0)), "_end": F.get("_both", F.lit(1))}).withColumn("ut_end", times.end_after_start(F.col("ut_start"), F.col("_end")))
    share = F.when(F.col("_count") == 1, F.col("_exp"))
    return timed.select(key, "exposure_num", (F.col("_p") + 1).alias("subexposure_num"), "ut_start", "ut_end", times.exposure_seconds(F.col("ut_start"), F.col("ut_end"), share).alias("exptime"), F.col("_exp").alias("stated_exptime"), F.col("_date").alias("date_orig")).withColumn(
        "ut_mid", times.mid_time(F.col("ut_start"), F.col("ut_end"), F.col("exptime"))
    )


def exposures_of(parts: DataFrame, key: str = "plate_id") -> DataFrame:
    """Parts put together: first start, last end, summed exposure time, Julian dates of the middle weighted by exposure time."""
    jd = times.julian_date(F.col("ut_mid"), None)
    weight = F.coalesce(F.col("exptime"), F.lit(1.0))
    put = parts.groupBy(key, "exposure_num").agg(
        F.min("ut_start").alias("ut_start"), F.max("ut_end").alias("ut_end"), F.count(F.lit(1)).alias("num_sub"), F.coalesce(F.max("stated_exptime"), F.sum("exptime")).alias("exptime"), F.try_divide(F.sum(jd * weight), F.sum(F.when(jd.isNotNull(), weight))).alias("_jd"), F.first("date_orig").alias("date_orig")
    )
    return put.select(key, "exposure_num", "date_orig", "ut_start", "ut_end", "num_sub", "exptime", F.round("_jd", 5).alias("jd_avg"), F.round(F.lit(2000.0) + (F.col("_jd") - 2451545.0) / 365.25, 8).alias("year_avg"))
