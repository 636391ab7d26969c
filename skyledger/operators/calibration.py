"""Photometric calibration of a plate's solution: curve of natural magnitudes, outliers, errors, residual surface.

The loop over cuts of the magnitude range is sequential, so a (plate, solution) is one group of a numpy kernel, in one task; what it
holds of a group of many stars is a flag for each, the rest is in files. Selection before and application after are column expressions.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.fits import lowess_counted, lowess_share
from skyledger.operators.smooth import Column, Values, curve_places, parts

LEAST_STARS = 10
#: Stars of a group whose columns are held in memory.
HELD = 2_000_000
CURVE = "plate_mag double, natmag double, error double, num_used long, num_outliers long, bright_limit double, faint_limit double"


def _support(mags: Values, share: float = 0.2) -> tuple[float, float, float]:
    """Range of magnitudes (ascending) with more than `share` of the greatest density, and the mode (Gaussian kernels of normal-reference width)."""
    n = len(mags)
    mean = sum(mags[p].sum() for p in parts(n)) / n
    deviation = (sum(((mags[p] - mean) ** 2).sum() for p in parts(n)) / n) ** 0.5
    quarters = [float(np.interp((n - 1) * q, [k, k + 1], [mags[k], mags[min(k + 1, n - 1)]])) for q in (0.25, 0.75) for k in [int((n - 1) * q)]]
    spread = min(deviation, (quarters[1] - quarters[0]) / 1.349) or deviation or 0.1
    width = 0.9 * spread * n**-0.2
    grid = np.linspace(mags[0] - 3 * width, mags[n - 1] + 3 * width, 256)
    counts, edges = np.histogram(mags[:1], 1024, (mags[0], mags[n - 1]))
    for k, p in enumerate(parts(n)):
        counts = counts * (k > 0) + np.histogram(mags[p], edges)[0]
    filled = np.flatnonzero(counts)
    density = np.exp(-(((grid[:, None] - ((edges[1:] + edges[:-1]) / 2)[filled]) / width) ** 2) / 2) @ counts[filled]
    dense = grid[density > share * density.max()]
    return float(dense[0]), float(dense[-1]), float(grid[density.argmax()])


def far_off(rest: np.ndarray, first: int, stop: int) -> np.ndarray:
    """Which of rest[first:stop] are over 1, or over three times the deviation by the median of the 50 around them, or 0.02.

    Only those with as many small ones around them as a median that low needs are looked at one by one."""
    out = rest > 1
    open_, upto = np.flatnonzero(~out & (rest > 0.06)), 0.06
    open_ = open_[(open_ >= first) & (open_ < stop)]
    while len(open_):
        upto *= 1.25
        own = open_[rest[open_] <= upto]
        open_ = open_[rest[open_] > upto]
        if len(own):
            small = np.append(0, np.cumsum(rest < upto / 4.4478 * (1 + 1e-9)))
            low, high = np.maximum(own - 25, 0), np.minimum(own + 25, len(rest))
            own = own[2 * (small[high] - small[low]) >= high - low]
        whole = own[(own >= 25) & (own + 25 <= len(rest))]
        for p in parts(len(whole), 4096):
            near = rest[whole[p, None] + np.arange(-25, 25)]
            out[whole[p]] = rest[whole[p]] > 3 * (1.4826 * np.median(near, axis=1))
        for k in own[(own < 25) | (own + 25 > len(rest))]:
            out[k] = rest[k] > 3 * (1.4826 * np.median(rest[max(k - 25, 0) : k + 25]))
    return out[first:stop]


def _some(values: Iterable[np.ndarray], n: int) -> Values:
    """Parts of n values in a row: in memory, or in a file if they are many."""
    if n <= HELD:
        return np.concatenate([np.zeros(0), *values])
    out = Column()
    for v in values:
        out.append(v)
    return out


def _rest(x: Values, y: Values, curve: tuple[np.ndarray, np.ndarray], own: slice, margin: int) -> tuple[np.ndarray, int, int]:
    """Residuals of a part with a margin on both sides, and the part's place among them."""
    around = slice(max(own.start - margin, 0), min(own.stop + margin, len(x)))
    return y[around] - np.interp(x[around], *curve), own.start - around.start, own.stop - around.start


def calibrated_in_order(x: Values, y: Values) -> dict | None:
    """As `calibrated`, for stars in the order of their magnitudes; many may be columns in files, and few are held at once."""
    n = len(x)
    places = 1
    while places < LEAST_STARS and n and (at := bisect_right(x, x[0] if places == 1 else v)) < n:
        places, v = places + 1, x[at]
    if n == 0 or places < LEAST_STARS:
        return None
    low, high, mode = _support(x)
    good = np.zeros(n, bool)
    good[bisect_left(x, low) : bisect_right(x, high)] = True
    if good.sum() < LEAST_STARS:
        good[:] = True

    def seen(stop: int) -> tuple[Values, Values]:
        count = int(good[:stop].sum())
        return tuple(_some((v[p][good[p]] for p in parts(stop)), count) for v in (x, y))

    # From the bright half outwards, half a magnitude at a time: what is far off the curve so far is out.
    edge = (low + mode) / 2 if mode > low else high
    while True:
        stop = bisect_right(x, edge)
        own_x, own_y = seen(stop)
        if (count := len(own_x)) >= LEAST_STARS:
            if count < 20:
                fit = np.polyval(np.polyfit(own_x, own_y, min(2, len(np.unique(own_x)) - 1)), own_x)
                out = far_off(np.abs(own_y - fit), 0, count)
            else:
                curve = curve_places(own_x, own_y, lowess_share(count), 3, 0.1)
                out = np.zeros(count, bool)
                for p in parts(count):
                    rest, first, last = _rest(own_x, own_y, curve, p, 25)
                    out[p] = far_off(np.abs(rest), first, last)
            good[:stop][good[:stop]] = ~out
        if edge >= high:
            break
        if bisect_right(x, edge + 1.5) == stop:
            good[stop:] = False
            break
        edge += 0.5
    if good.sum() < LEAST_STARS:
        return None
    cx, cy = seen(n)
    count = len(cx)
    curve = curve_places(cx, cy, lowess_share(count), 0, 0.1)

    def error(at: np.ndarray) -> np.ndarray:
        """Root of the mean square of the residuals of ten stars around a magnitude; the ends' are mirrored."""

        def one(k: int) -> float:
            own = np.arange(k - 5, k + 5)
            own = np.where(own < 0, -1 - own, np.where(own >= count, 2 * count - 1 - own, own))
            return float(np.sqrt(((cy[own] - np.interp(cx[own], *curve)) ** 2).mean()))

        def value(v: float) -> float:
            k = bisect_right(cx, v) - 1
            if k < 0 or k >= count - 1:
                return one(0 if k < 0 else count - 1)
            a, b = one(k), one(k + 1)
            return a + (b - a) * (v - cx[k]) / (cx[k + 1] - cx[k])

        return np.array([value(v) for v in at.tolist()])

    return {"x": curve[0], "y": curve[1], "error": error, "good": good, "low": float(cx[0]), "high": float(cx[count - 1])}


def calibrated(mag: np.ndarray, nat: np.ndarray) -> dict | None:
    """Places of the curve over plate magnitudes (straight between them), its running error as a function, and which stars are outliers;
    None with too few stars."""
    order = None if (mag[:-1] <= mag[1:]).all() else np.argsort(mag, kind="stable")
    found = calibrated_in_order(*((mag, nat) if order is None else (mag[order], nat[order])))
    if found is None:
        return None
    good = found.pop("good")
    out = ~good
    if order is not None:
        out[order] = ~good
    return found | {"outlier": out}


def calibration_curves(stars: DataFrame, groups: list[str], step: float = 0.1) -> DataFrame:
    """Sampled curves: groups, plate_mag, natmag, error, counts and limits. stars: groups, mag, natmag.

    A group's stars come in order, batch by batch, and go to files where they are many."""
    kinds = T.StructType([*stars.select(*groups).schema.fields, *T.StructType.fromDDL(CURVE).fields])
    names = [f.name for f in kinds.fields]

    def fit(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = gathered(batches, ["mag", "natmag"])
        found = calibrated_in_order(*columns) if len(columns[0]) >= LEAST_STARS else None
        if found is None:
            return
        grid = np.arange(np.ceil(found["low"] / step) * step, found["high"] + 1e-9, step) if found["high"] - found["low"] > step else np.array([found["low"], found["high"]])
        n, used = len(grid), int(found["good"].sum())
        same = [pa.array([used] * n, pa.int64()), pa.array([len(found["good"]) - used] * n, pa.int64()), pa.array([found["low"]] * n), pa.array([found["high"]] * n)]
        yield pa.RecordBatch.from_arrays([*(pa.repeat(k, n) for k in key), pa.array(grid), pa.array(np.interp(grid, found["x"], found["y"])), pa.array(found["error"](grid)), *same], names=names)

    known = stars.select(*groups, *(F.col(c).cast("double").alias(c) for c in ("mag", "natmag"))).where("mag IS NOT NULL AND natmag IS NOT NULL AND NOT isnan(mag) AND NOT isnan(natmag)")
    return known.repartition(*groups).sortWithinPartitions(*groups, "mag", "natmag").groupBy(*groups).applyInArrow(fit, kinds)


def gathered(batches: Iterator[pa.RecordBatch], columns: list[str]) -> list[Values]:
    """The columns of all batches, in memory or, of many rows, in files."""
    out: list = [[] for _ in columns]
    n = 0
    for batch in batches:
        n += batch.num_rows
        if n > HELD and isinstance(out[0], list):
            out, held = [Column() for _ in columns], out
            for column, values in zip(out, held, strict=True):
                for v in values:
                    column.append(v)
            del held
        for column, name in zip(out, columns, strict=True):
            column.append(batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(float))
    return [np.concatenate([np.zeros(0), *v]) if isinstance(v, list) else v for v in out]


def applied(sources: DataFrame, curves: DataFrame, group: str, colour: str = "color_term", correction: str = "natmag_correction") -> DataFrame:
    """natmag, rpmag, bpmag and errors of all sources from their group's curve; flags 1 brighter and 2 fainter than its limits.
    Where a group has no curve these are null, and the flag 0."""
    from skyledger.operators.fits import checkpointed, group_parts, interpolated, with_group

    c, parts = F.col, group_parts(sources, group)
    # The curves are used twice and cost far more than to store them.
    curves = checkpointed(curves)
    placed = interpolated(sources, curves, group, "mag", "plate_mag", "natmag", "_curve", parts, {"_error": "error"})
    limits = curves.groupBy(group).agg(F.min("bright_limit").alias("_lo"), F.max("faint_limit").alias("_hi"), F.min_by("error", "plate_mag").alias("_elo"), F.max_by("error", "plate_mag").alias("_ehi"))
    nat = c("_curve") + F.coalesce(c(correction), F.lit(0.0))
    error = F.when(c("mag") < c("_lo"), c("_elo")).when(c("mag") > c("_hi"), c("_ehi")).otherwise(c("_error"))
    joined = with_group(placed, limits, [group], "left").withColumns({"natmag": nat, "natmag_error": F.sqrt(F.pow(error, 2) + F.pow(F.coalesce(c("magerr"), F.lit(0.0)), 2))})
    return joined.withColumns(
        {"rpmag": c("natmag") - c(colour) * c("color"), "bpmag": c("natmag") - (c(colour) - 1) * c("color"), "phot_range_flag": F.when(c("mag") < c("_lo"), 1).when(c("mag") > c("_hi"), 2).otherwise(0)}
    ).drop("_curve", "_error", "_lo", "_hi", "_elo", "_ehi")


def scanner_pattern(rows: DataFrame, plate: str, axis: str, residual: str, size: float, key: str, step: float = 50.0) -> DataFrame:
    """Smooth residuals along an axis, sampled every `step` pixels: plate, position, value, extrapolated; and the ratio of the
    curve's deviation to the residuals' in the central 60 %.

    Stars of a plate with the same place on the axis and the same residual go to the kernel as one row with their number; as they
    are alike, no order by `key` is needed between them."""
    kind = rows.select(plate).schema[0].dataType.simpleString()
    columns = [plate, "position", "value", "extrapolated", "strength"]

    def fit(table: pa.Table) -> pa.Table:
        at, value, times = (table.column(c).to_numpy() for c in ("_at", "_value", "_times"))
        grid, filled = np.arange(0.0, size + 1e-9, step), int(times.sum()) >= LEAST_STARS
        if filled:
            order = np.lexsort((value, at))
            at, value, times = at[order], value[order], times[order]
            curve = lowess_counted(at, value, times, max(10 / times.sum(), times.sum() ** -0.5), 3, step / 5)
            middle = np.linspace(0.2 * size, 0.8 * size, 60)
            rest = value - curve
            spread = np.average((rest - np.average(rest, weights=times)) ** 2, weights=times) ** 0.5
            strength = np.interp(middle, at, curve).std() / max(spread, 1e-12)
            found = [np.interp(grid, at, curve), (grid < at[0]) | (grid > at[-1]), np.full(len(grid), strength)]
        else:
            grid, found = grid[:0], [np.zeros(0), np.zeros(0, bool), np.zeros(0)]
        own = table.column(plate).slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(grid), np.int64)))
        return pa.table([own, pa.array(grid), *map(pa.array, found)], names=columns)

    at, value = F.col(axis).cast("double"), F.col(residual).cast("double")
    seen = rows.where(~F.isnan(at) & ~F.isnan(value) & at.isNotNull() & value.isNotNull())
    counted = seen.groupBy(plate, at.alias("_at"), value.alias("_value")).agg(F.count(F.lit(1)).alias("_times"))
    return counted.groupBy(plate).applyInArrow(fit, f"{plate} {kind}, position double, value double, extrapolated boolean, strength double")
