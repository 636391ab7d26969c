"""Detections on a plate: distances, border scores, annular bins, flags, selections, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distances(rows: DataFrame, width: float, height: float, x: str = "x", y: str = "y") -> DataFrame:
    """dist_center and dist_edge (pixels) of detections on an image."""
    a, b = F.col(x), F.col(y)
    return rows.withColumns({"dist_center": F.sqrt(F.pow(a - width / 2, 2) + F.pow(b - height / 2, 2)), "dist_edge": F.least(a, b, F.lit(width) - a, F.lit(height) - b)})


def background_stats(rows: DataFrame, plate: str, half: float, background: str = "background") -> DataFrame:
    """Per plate mean and population deviation of the background between 0.1 and 0.9 half heights from the edge; of all
    rows if at most three lie there."""
    inside = F.when((F.col("dist_edge") > 0.1 * half) & (F.col("dist_edge") < 0.9 * half), F.col(background))
    pick = lambda f: F.when(F.count(inside) > 3, f(inside)).otherwise(f(background))
    return rows.groupBy(plate).agg(pick(F.avg).alias("bg_mean"), pick(F.stddev_pop).alias("bg_std"))


def with_background(rows: DataFrame, plate: list[str], half: float, background: str = "background") -> DataFrame:
    """`rows` with bg_mean and bg_std of `background_stats`, by windows: rows that are dealt by plate stay where they are."""
    own = Window.partitionBy(*plate)
    inside = F.when((F.col("dist_edge") > 0.1 * half) & (F.col("dist_edge") < 0.9 * half), F.col(background))
    pick = lambda f: F.when(F.count(inside).over(own) > 3, f(inside).over(own)).otherwise(f(background).over(own))
    return rows.withColumns({"bg_mean": pick(F.avg), "bg_std": pick(F.stddev_pop)})


def border_score(rows: DataFrame, width: float, height: float, x: str = "x", y: str = "y", background: str = "background") -> Column:
    """|background - mean| in deviations, over the relative distance to the nearest edge."""
    rel = F.least(F.col(x) / width, F.lit(1.0) - F.col(x) / width, F.col(y) / height, F.lit(1.0) - F.col(y) / height)
    return F.try_divide(F.abs(F.col(background) - F.col("bg_mean")), F.col("bg_std")) / F.greatest(rel, F.lit(1e-5))


def flags() -> dict[str, Column]:
    """flag_clean, flag_rim, flag_negradius from flux_radius, elongation, magerr, border."""
    c = F.col
    clean = (c("flux_radius") > 0) & (c("elongation") < 5) & (c("magerr") < 5) & (c("border") < 100)
    yes = lambda v: F.when(v, 1).otherwise(0)
    return {"flag_clean": yes(clean), "flag_rim": yes(c("border") >= 100), "flag_negradius": yes(c("flux_radius") <= 0)}


def bin_edges(width: int, height: int, step: int = 100) -> list[float]:
    """Radii of eight rings of about equal area, from a lattice of image points away from the margin: seven steps of 12.5
    percentiles and the outer radius, 5/12 of the diagonal. A function of the image's size alone."""
    import numpy as np

    outer = (width**2 + height**2) ** 0.5 * 5 / 12
    margin = int(0.1 * min(width, height) / 2 / step)
    xs, ys = np.arange(0, width, step), np.arange(0, height, step)
    xs, ys = (v[margin : len(v) - margin] if margin else v for v in (xs, ys))
    r = np.hypot(xs[:, None] - width / 2, ys[None, :] - height / 2).ravel()
    return [float(v) for v in np.percentile(r[r <= outer], [12.5 * k for k in range(1, 8)])] + [outer]


def annular_bin(edges: list[float], width: float, height: float) -> Column:
    """1 to 8 by distance from the centre, 9 near an edge or beyond the last ring, else 0."""
    r = F.col("dist_center")
    chosen = F.when((F.col("dist_edge") < 0.1 * min(width, height) / 2) | (r >= edges[-1]), 9)
    for k, upper in enumerate(edges):
        chosen = chosen.when((r >= (edges[k - 1] if k else 0.0)) & (r < upper), k + 1)
    return chosen.otherwise(0)


def calibration_stars(multiple: bool = False) -> Column:
    """Which detections serve for calibration."""
    c = F.col
    flag = c("phot_flag").isin(0, 2) if not multiple else c("phot_flag") <= 3
    return c("solution_num").isNotNull() & (c("mag") > 0) & (c("mag") < 90) & flag & (c("flag_clean") == 1) & c("bp").isNotNull() & c("rp").isNotNull() & (F.coalesce(c("bp") - c("rp"), F.lit(99.0)) <= 2) & (c("neighbours") == 1)


def colour_subset(rows: DataFrame, group: str, bin_col: str = "annular_bin", enough: int = 50) -> DataFrame:
    """Per group the rows of bins to 3; where they are fewer than `enough`, of bins to 6."""
    inner = F.sum((F.col(bin_col) <= 3).cast("int")).over(Window.partitionBy(group))
    return rows.withColumn("_inner", inner).filter((F.col(bin_col) <= 3) | (F.col("_inner") < enough) & (F.col(bin_col) <= 6)).drop("_inner")


def calibration_flags(rows: DataFrame, used: DataFrame, outliers: DataFrame, key: str) -> DataFrame:
    """phot_calib_flag: 1 used, 2 outlier (which wins), else 0."""
    a, b = used.select(key, F.lit(1).alias("_used")).distinct(), outliers.select(key, F.lit(2).alias("_out")).distinct()
    return rows.join(a, key, "left").join(b, key, "left").withColumn("phot_calib_flag", F.coalesce("_out", "_used", F.lit(0))).drop("_used", "_out")


def brightest(rows: DataFrame, mag: str, key: str, skip: int, keep: int) -> DataFrame:
    """By magnitude (ties by key) the rows after the first `skip`, `keep` of them: a bounded top-k, not a full sort."""
    return rows.orderBy(mag, key).offset(skip).limit(keep)


def stars_to_keep(n_bins: int, exposures: int, longest: float, shortest: float) -> int:
    """How many stars the solver gets."""
    import math

    f = min(4.0, max(1.0, math.log10(longest / shortest) + 1)) if shortest > 0 else 1.0
    return int(min(max(1000, n_bins * exposures * f / 100), 100000 / exposures))


def nth_largest(rows: DataFrame, group: str, value: str, n: int, key: str) -> DataFrame:
    """Per group the value with n larger ones before it."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), key)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == n + 1).select(group, F.col(value).alias("threshold"))


def match_tolerance(rows: DataFrame, pixel_scale: float, groups: list[str] | None = None) -> DataFrame:
    """Tolerance from solutions' dispersions sigma1, sigma2 weighted by ndeg (rows of more than 10): root of the sum of squares,
    widened for few stars, twice the pixel scale where there is nothing to go by."""
    n = F.when(F.col("sigma1").isNotNull() & (F.col("ndeg") > 10), F.col("ndeg"))
    mean = lambda c: F.try_divide(F.sum(F.col(c) * n), F.sum(n))
    summed = rows.groupBy(*(groups or [])).agg(mean("sigma1").alias("w1"), mean("sigma2").alias("w2"), F.sum(n).alias("total"), F.avg(n).alias("per"))
    sigma = F.sqrt(F.pow("w1", 2) + F.pow("w2", 2))
    wide = F.when(F.col("total") < 30, sigma * 30 / F.col("total")).otherwise(sigma)
    return summed.withColumn("_wide", wide).select(*(groups or []), F.when(F.col("_wide").isNull() | (F.col("_wide") < 0.1 * pixel_scale) & (F.col("per") < 20), 2.0 * pixel_scale).otherwise(F.col("_wide")).alias("sigma"), F.col("total").cast("long").alias("num_stars"))


def counts_with_zeros(rows: DataFrame, groups: DataFrame, key: str, name: str = "n") -> DataFrame:
    """A count for every group of `groups`, 0 where `rows` has none."""
    return groups.select(key).join(rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def unique_first(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Of rows with equal value the first by `order`."""
    return rows.groupBy(value).agg(F.min_by(F.struct(*(c for c in rows.columns if c != value)), order).alias("_r")).select(value, *(F.col(f"_r.{c}").alias(c) for c in rows.columns if c != value))


def inside_fences(rows: DataFrame, group: str, value: str, factor: float = 1.5) -> DataFrame:
    """Rows within `factor` quartile ranges of their group's quartiles (exact percentiles, joined back)."""
    q = rows.groupBy(group).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    a, b = F.col("_q")[0], F.col("_q")[1]
    return rows.join(q, group).filter(F.col(value).between(a - (b - a) * factor, b + (b - a) * factor)).drop("_q")


def midrange(value: str) -> Column:
    return (F.min(value) + F.max(value)) / 2


def rms(value: Column) -> Column:
    return F.sqrt(F.avg(value * value))


def weighted_rms(value: Column, error: Column) -> Column:
    """Root mean square of value / error, times that of the error."""
    return F.sqrt(F.avg(F.pow(F.try_divide(value, error), 2))) * F.sqrt(F.avg(error * error))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def moving_rms(rows: DataFrame, group: str, order: list[str], value: str, name: str = "rms") -> DataFrame:
    """Root mean square over ten rows, five before to four after; rows beyond an end mirror those at the end.

    The mirrored rows are added as copies, at most five before the first and four after the last of each group.
    """
    w = Window.partitionBy(group).orderBy(*order)
    placed = rows.withColumns({"_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(group)), "_sq": F.pow(value, 2)})
    places = F.filter(F.array(F.col("_i"), F.when(F.col("_i") <= 5, 1 - F.col("_i")), F.when(F.col("_n") - F.col("_i") < 4, 2 * F.col("_n") + 1 - F.col("_i"))), lambda x: x.isNotNull())
    spread = placed.withColumn("_at", F.explode(places))
    window = Window.partitionBy(group).orderBy("_at").rowsBetween(-5, 4)
    return spread.withColumn(name, F.sqrt(F.avg("_sq").over(window))).filter("_at = _i").drop("_i", "_n", "_sq", "_at")


def blend_weights(rows: DataFrame, group: str, order: list[str], n: int, name: str = "blend") -> DataFrame:
    """0, 1/n, 2/n ... for the first n rows of a group, 1 after them."""
    i = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn(name, F.least((i - 1) / F.lit(float(n)), F.lit(1.0)))


def local_weights(rows: DataFrame, group: str, mag: str, value: str, reach: float = 1.0, name: str = "weight") -> DataFrame:
    """1 / variance of `value` among rows of the group less than `reach` magnitudes away, if there are more than two.

    A range frame holds rows at exactly the reach too; they are taken out again by their own sums.
    """
    frame = lambda what, a, b: f"coalesce(sum({what}) OVER (PARTITION BY `{group}` ORDER BY `{mag}` RANGE BETWEEN {a} AND {b}), 0D)"
    before, after = f"{float(reach)!r}D PRECEDING", f"{float(reach)!r}D FOLLOWING"
    inner = lambda what: F.expr(f"{frame(what, before, after)} - {frame(what, before, before)} - {frame(what, after, after)}")
    n, s, q = inner("1D"), inner(f"`{value}`"), inner(f"`{value}` * `{value}`")
    counted = rows.withColumns({"_n": n, "_s": s, "_q": q})
    variance = F.col("_q") / F.col("_n") - F.pow(F.col("_s") / F.col("_n"), 2)
    return counted.withColumn(name, F.when(F.col("_n") > 2, F.try_divide(F.lit(1.0), F.when(variance > 1e-12, variance)))).drop("_n", "_s", "_q")


def brightest_share(rows: DataFrame, group: str, mag: str, key: str, share: float = 0.02, least: int = 5, most: int = 2000) -> DataFrame:
    """The brightest share of each group, at least `least` and at most `most` rows."""
    w = Window.partitionBy(group)
    n = F.greatest(F.least(F.floor(F.count(F.lit(1)).over(w) * share), F.lit(most)), F.lit(least))
    return rows.withColumns({"_i": F.row_number().over(w.orderBy(mag, key)), "_k": n}).filter("_i <= _k").drop("_i", "_k")


def sub_exposure_sums(rows: DataFrame, key: str, order: list[str], start: str, exptime: str) -> DataFrame:
    """Per exposure the first and last start of its parts, their number and summed exposure time."""
    at = F.struct(*order)
    return rows.groupBy(key).agg(F.min_by(start, at).alias("first_start"), F.max_by(start, at).alias("last_start"), F.count(F.lit(1)).alias("num_sub"), F.sum(exptime).alias("exptime"))


def solution_pairs(rows: DataFrame, key: str, plate: str, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Per plate the pair of its solutions that lie farthest apart; a plate has a handful of solutions."""
    from skyledger.functions import sky

    a = rows.select(plate, F.col(key).alias("a_num"), F.col(ra).alias("a_ra"), F.col(dec).alias("a_dec"))
    b = rows.select(plate, F.col(key).alias("b_num"), F.col(ra).alias("b_ra"), F.col(dec).alias("b_dec"))
    pairs = a.join(b, plate).filter("a_num < b_num").withColumn("sep", sky.separation(F.col("a_ra"), F.col("a_dec"), F.col("b_ra"), F.col("b_dec")))
    best = pairs.groupBy(plate).agg(F.max(F.struct("sep", "a_num", "b_num")).alias("m"))
    return best.select(plate, F.col("m.a_num").alias("a_num"), F.col("m.b_num").alias("b_num"), F.col("m.sep").alias("sep"))
