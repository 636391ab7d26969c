"""Photometric calibration of a plate's solution with its colour term, residual surfaces and errors by magnitude.

The stars of one (plate, solution) are one group of a numpy kernel: its steps depend on each other, and a plate's stars fit in a
task. A smoothing without robust rounds is linear in the values, so a scan of colour terms c needs two smoothed curves only:
the residuals of RP + c (BP - RP) are those of RP plus c times those of the colour.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.operators import smooth
from skyledger.operators.calibration import LEAST_STARS, _some, _support, calibrated, calibrated_in_order, gathered
from skyledger.operators.fits import checkpointed, lowess, lowess_share, with_group
from skyledger.operators.smooth import parts

#: Range of valid colour terms, and the deviation below which a scan says nothing.
VALID, LEAST_STAT = (-3.0, 5.0), 0.01
COARSE, FINE, FINE_HALF = np.arange(45) * 0.25 - 4.0, 0.02, 20
#: Magnitudes from the plate's limit within which stars are too faint for the colour term, if enough remain.
FAINT_EDGE, ENOUGH = 1.0, 100
#: Stars whose terms of a surface are held at once.
PART = 200_000


def vee_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least squares of a |x - x0| + b (x - x0)^2 + c: (x0, a, b, c) and their standard errors.

    For a given x0 the rest is linear, so only x0 is searched: on a grid, then on finer ones around its best point."""

    def solved(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squares of the residuals, and coefficients, for many x0 at once."""
        u = x - places[:, None]
        q, r = np.linalg.qr(np.stack((np.abs(u), u * u, np.ones_like(u)), -1))
        along = np.einsum("gij,i->gj", q, y)
        return ((y - np.einsum("gij,gj->gi", q, along)) ** 2).sum(1), np.linalg.solve(r, along[..., None])[..., 0]

    low, high, grid = x.min(), x.max(), np.linspace(x.min(), x.max(), 4 * len(x) + 1)
    while high - low > 1e-9:
        best = int(np.argmin(solved(grid)[0]))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, len(grid) - 1)]
        grid = np.linspace(low, high, 41)
    x0 = (low + high) / 2
    (rest,), ((a, b, c),) = solved(np.array([x0]))
    u = x - x0
    jacobian = np.stack((-a * np.sign(u) - 2 * b * u, np.abs(u), u * u, np.ones_like(u)), -1)
    spread = np.linalg.pinv(jacobian.T @ jacobian) * rest / max(1, len(x) - 4)
    return np.array([x0, a, b, c]), np.sqrt(np.maximum(np.diag(spread), 0))


def weighted_parabola(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """y = p x^2 + q x + r with weights on the residuals: coefficients, and their standard errors by the scatter."""
    m = np.stack((x * x, x, np.ones_like(x)), -1) * w[:, None]
    inverse = np.linalg.pinv(m.T @ m)
    p = inverse @ (m.T @ (w * y))
    rest = ((w * y - m @ p) ** 2).sum() / max(1, len(x) - 3)
    return p, np.sqrt(np.maximum(np.diag(inverse) * rest, 0))


def scan(mag: np.ndarray, rp: np.ndarray, colour: np.ndarray, corr: np.ndarray, err: np.ndarray, terms: np.ndarray, share: float) -> np.ndarray:
    """For each term c the weighted deviation of RP + c * colour from its smooth curve over mag (ascending)."""
    base = rp - lowess(mag, rp, share, 0, 0.2) - corr
    slope = colour - lowess(mag, colour, share, 0, 0.2)
    # Term by term: all at once would take as many copies of the stars as there are terms.
    return np.sqrt(np.array([(((base + term * slope) / err) ** 2).mean() for term in terms])) * np.sqrt((err**2).mean())


def clipped(values: np.ndarray, sigma: float = 3.0) -> np.ndarray:
    """Which values stay when those beyond sigma deviations of the median go, until none does."""
    stay = np.ones(len(values), bool)
    while True:
        own = values[stay]
        now = stay & (np.abs(values - np.median(own)) <= sigma * own.std())
        if now.sum() == stay.sum() or not now.any():
            return stay
        stay = now


def colour_term(mag: np.ndarray, bp: np.ndarray, rp: np.ndarray, corr: np.ndarray | None = None, err: np.ndarray | None = None) -> dict[str, float] | None:
    """color_term with its error, fitted and least deviation, range of the last scan, iterations and stars; None without a valid one."""
    corr = np.zeros(len(mag)) if corr is None else np.nan_to_num(corr)
    err = np.ones(len(mag)) if err is None else np.where(np.isfinite(err) & (err > 0), err, 1.0)
    # One star for each BP magnitude, then for each plate magnitude.
    first = np.sort(np.unique(bp, return_index=True)[1])
    own = mag[first]
    first = first[np.append(True, own[1:] != own[:-1]) if (own[:-1] <= own[1:]).all() else np.sort(np.unique(own, return_index=True)[1])]
    del own
    order = first[np.argsort(mag[first], kind="stable")]
    if len(order) < LEAST_STARS:
        return None
    if len(order) > ENOUGH:
        order = order[mag[order] < _support(mag[order])[1] - FAINT_EDGE]
        if len(order) < LEAST_STARS:
            return None
    x, rp, colour, corr, err = mag[order], rp[order], (bp - rp)[order], corr[order], err[order]
    stat = scan(x, rp, colour, corr, err, COARSE, lowess_share(len(x)))
    if stat.max() < LEAST_STAT:
        return None
    (centre, *_), _ = vee_fit(COARSE, stat)
    if not VALID[0] <= centre <= VALID[1]:
        return None
    nat = rp + centre * colour
    off = nat - lowess(x, nat, lowess_share(len(x)), 3, 0.2) - corr
    near = np.flatnonzero(np.abs(off) <= 1.5)
    if len(near) == 0:
        return None
    good = near[clipped(off[near])]
    if len(good) < LEAST_STARS:
        return None
    own, share = (x[good], rp[good], colour[good], corr[good], err[good]), lowess_share(len(good))
    stat = scan(*own, COARSE, share)
    if stat.max() < LEAST_STAT:
        return None
    (centre, a, _, _), (error, *_) = vee_fit(COARSE, stat)
    if not VALID[0] <= centre <= VALID[1] or a < 0 or stat.min() < LEAST_STAT:
        return None
    second = {"color_term": centre, "color_term_error": error, "cterm_stdev_fit": float("nan"), "cterm_stdev_min": stat.min(), "cterm_range_min": COARSE[0], "cterm_range_max": COARSE[-1], "cterm_iterations": 2, "cterm_num_stars": len(good)}
    terms = (round(centre / FINE) + np.arange(-FINE_HALF, FINE_HALF + 1)) * FINE
    stat = scan(*own, terms, share)
    (p, q, r), (p_err, q_err, _) = weighted_parabola(terms, stat, 1 / stat**2)
    vertex = -q / (2 * p) if p else float("inf")
    if p < 0 or not VALID[0] <= vertex <= VALID[1]:
        return second
    return {
        "color_term": vertex, "color_term_error": float(np.hypot(q_err / (2 * p), q * p_err / (2 * p * p))), "cterm_stdev_fit": p * vertex**2 + q * vertex + r, "cterm_stdev_min": stat.min(),
        "cterm_range_min": terms[0], "cterm_range_max": terms[-1], "cterm_iterations": 3, "cterm_num_stars": len(good),
    }


TERM = "color_term double, color_term_error double, cterm_stdev_fit double, cterm_stdev_min double, cterm_range_min double, cterm_range_max double, cterm_iterations int, cterm_num_stars long"


def _grouped(stars: DataFrame, groups: list[str], columns: list[str], schema: str, kernel: Callable[[pd.DataFrame], dict | None]) -> DataFrame:
    """A row for each group that `kernel` has one for."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stars.select(*groups).schema)
    names = [part.split()[0] for part in schema.split(", ")]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        found = kernel(pdf)
        if found is None:
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in (*groups, *names)})
        return pd.DataFrame({g: [pdf[g].iloc[0]] for g in groups} | {n: [found[n]] for n in names})

    return stars.select(*groups, *columns).groupBy(*groups).applyInPandas(fit, f"{kinds}, {schema}")


def _in_order(pdf: pd.DataFrame, columns: list[str], key: str) -> list[np.ndarray]:
    """The columns of rows that have them all, by mag and key, without copies of the frame."""
    values = {c: pdf[c].to_numpy(float) for c in columns}
    known = np.ones(len(pdf), bool)
    for v in values.values():
        known &= ~np.isnan(v)
    order = np.flatnonzero(known)
    order = order[np.lexsort((pdf[key].to_numpy()[order], values["mag"][order]))]
    return [values[c][order] for c in columns]


def colour_terms(stars: DataFrame, groups: list[str], key: str = "id") -> DataFrame:
    """The colour term of each group of stars (mag, bp, rp; key orders stars of equal magnitudes).

    The method takes the first star of each BP magnitude, so only these go to the kernel."""
    columns = ["mag", "bp", "rp"]
    known = stars.select(*groups, key, *(F.col(c).cast("double").alias(c) for c in columns)).where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in columns))
    first = known.groupBy(*groups, "bp").agg(F.min(F.struct("mag", key, "rp")).alias("_star"))
    # A group without a star is none.
    return _grouped(first.select(*groups, "bp", "_star.*"), groups, [key, *columns], TERM, lambda pdf: colour_term(*_in_order(pdf, columns, key)))


def local_outliers(mag: np.ndarray, residual: np.ndarray, low: float, high: float, mean: bool = False) -> np.ndarray:
    """Which stars are out by 3 times the root of the sum (with `mean`, the mean) of squares of the residuals of those that are
    still in within half a magnitude, at 100 places from `low` to `high`, in turn; a place needs five stars."""
    out = np.zeros(len(mag), bool)
    for at in np.linspace(low, high, 100):
        own = np.flatnonzero((mag > at - 0.5) & (mag < at + 0.5) & ~out)
        if len(own) >= 5:
            square = residual[own] ** 2
            out[own[np.abs(residual[own]) > 3 * np.sqrt(square.mean() if mean else square.sum())]] = True
    return out


def magnitude_bins(mags: np.ndarray, stars: int = 100, width: float = 0.5) -> list[tuple[float, float]]:
    """Lower and upper edges of adjoining bins over all magnitudes: each has `stars` more of them or `width`, whichever reaches
    farther; what would have fewer than `stars` at the faint end belongs to the last one."""
    x = np.sort(mags)
    if len(x) <= 2 * stars:
        return [(float(x[0]), float(x[-1]))] if len(x) else []
    edges, last = [float(x[0]), float(x[stars - 1])], stars - 1
    while last + stars < len(x) - 1:
        edges.append(max(float(x[last + stars]), edges[-1] + width))
        last = int((x <= edges[-1]).sum()) - 1
    edges[-1] = float(x[-1])
    return list(zip(edges[:-1], edges[1:], strict=True))


class Surface:
    """A polynomial of two coordinates by least squares, in coordinates scaled to the data's range."""

    def __init__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, degree: int):
        self.degree = degree
        self.box = [(v.min(), max(np.ptp(v), 1e-9)) for v in (x, y)]
        if len(x) <= PART:
            self.terms = np.linalg.lstsq(self._basis(x, y), z, rcond=None)[0]
            return
        # Many stars by parts: each part's triangle takes the place of its rows.
        triangle = np.empty((0, (degree + 1) * (degree + 2) // 2 + 1))
        for k in range(0, len(x), PART):
            own = slice(k, k + PART)
            triangle = np.linalg.qr(np.vstack((triangle, np.column_stack((self._basis(x[own], y[own]), z[own])))), mode="r")
        self.terms = np.linalg.lstsq(triangle[:, :-1], triangle[:, -1], rcond=None)[0]

    def _basis(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        # Beyond the data the value at the edge holds.
        u, v = (np.clip((w - low) / span, 0, 1) * 2 - 1 for w, (low, span) in zip((x, y), self.box, strict=True))
        us, vs = ([np.ones_like(w), *np.cumprod(np.broadcast_to(w, (self.degree, *w.shape)), axis=0)] for w in (u, v))
        return np.stack([us[i] * vs[j] for i in range(self.degree + 1) for j in range(self.degree + 1 - i)], -1)

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x, y = np.asarray(x, float), np.asarray(y, float)
        return np.concatenate([self._basis(x[k : k + PART], y[k : k + PART]) @ self.terms for k in range(0, len(x), PART)]) if len(x) > PART else self._basis(x, y) @ self.terms


def surface_of(x: np.ndarray, y: np.ndarray, residual: np.ndarray) -> Surface | None:
    """Of degree 5 for more than 100 stars, 3 for more than 50, none for fewer (polynomials in place of smoothing splines)."""
    return Surface(x, y, residual, 5) if len(x) > 100 else Surface(x, y, residual, 3) if len(x) > 50 else None


class Correction:
    """What a residual is expected to be at a place and magnitude: a surface, and for more than 500 stars a cubic one of the
    rest in each bin of magnitudes, interpolated between the bins' middles."""

    def __init__(self, x: np.ndarray, y: np.ndarray, mag: np.ndarray, residual: np.ndarray):
        self.whole, self.bins = surface_of(x, y, residual), []
        if self.whole is not None and len(x) > 500:
            rest = residual - self.whole(x, y)
            for k, (low, high) in enumerate(magnitude_bins(mag)):
                own = (mag > low) & (mag <= high) | (k == 0) & (mag == low)
                if own.sum() > 50:
                    self.bins.append(((low + high) / 2, Surface(x[own], y[own], rest[own], 3)))

    def __call__(self, x: np.ndarray, y: np.ndarray, mag: np.ndarray) -> np.ndarray:
        if self.whole is None:
            return np.zeros(len(x))
        out = self.whole(x, y)
        if self.bins:
            at = np.array([m for m, _ in self.bins])
            if len(at) == 1:
                return out + self.bins[0][1](x, y)
            right = np.clip(np.searchsorted(at, mag), 1, len(at) - 1)
            share = np.clip((mag - at[right - 1]) / (at[right] - at[right - 1]), 0, 1)
            # Each bin's surface at the stars beside it only.
            lower, upper = np.zeros(len(mag)), np.zeros(len(mag))
            for k, (_, surface) in enumerate(self.bins):
                for values, own in ((lower, right - 1 == k), (upper, right == k)):
                    values[own] = surface(x[own], y[own])
            out = out + (1 - share) * lower + share * upper
        return out


RESULT = TERM + ", bright_limit double, faint_limit double, num_calib_stars long, num_outliers long, rmse_min double, rmse_median double, rmse_max double, curve_mag array<double>, curve_natmag array<double>, curve_error array<double>"


def calibrated_solution(mag: np.ndarray, bp: np.ndarray, rp: np.ndarray, x: np.ndarray, y: np.ndarray, step: float = 0.1) -> dict | None:
    """The chain for one solution: colour term, curve with outliers, local clipping, correction over the plate, errors by bins.

    None where the colour term or the curve has too few stars."""
    found = _calibrated(mag, bp, rp, x, y, step)
    return found[0] if found else None


def _calibrated(mag: np.ndarray, bp: np.ndarray, rp: np.ndarray, x: np.ndarray, y: np.ndarray, step: float, corr: np.ndarray | None = None, err: np.ndarray | None = None) -> tuple[dict, Correction, Callable] | None:
    """The result, the correction and the error at a magnitude; corr of an earlier round goes into the colour term and the curve, err into the term."""
    term, n = colour_term(mag[:], bp[:], rp[:], corr, err), len(mag)
    if term is None:
        return None
    value = lambda p: rp[p] + term["color_term"] * (bp[p] - rp[p])
    # Freed of what an earlier round found over the plate, the curve's ends, which few stars hold, have their slope.
    nat = value if corr is None else lambda p: value(p) - corr[p]
    if isinstance(mag, smooth.Column):
        # Columns in files are in order, and are read when they are wanted.
        found = calibrated_in_order(mag, _some((nat(p) for p in parts(n)), n))
        good = found and np.flatnonzero(found.pop("good"))
    else:
        found = calibrated(mag, nat(slice(0, n)))
        good = found and np.flatnonzero(~found["outlier"])
    if found is None:
        return None
    mag, residual = mag[:][good], np.concatenate([value(p) for p in parts(n)])[good]
    residual -= np.interp(mag, found["x"], found["y"])
    stay = ~local_outliers(mag, residual, found["low"], found["high"])
    good, mag, residual = good[stay], mag[stay], residual[stay]
    x, y = x[:][good], y[:][good]
    correction = Correction(x, y, mag, residual)
    rest = residual - correction(x, y, mag)
    bins = magnitude_bins(mag)
    rmse = np.array([np.sqrt((rest[(mag >= low) & (mag <= high)] ** 2).mean()) for low, high in bins])
    middles = np.array([(low + high) / 2 for low, high in bins])
    grid = np.arange(np.ceil(found["low"] / step) * step, found["high"] + 1e-9, step) if found["high"] - found["low"] > step else np.array([found["low"], found["high"]])
    result = term | {
        "bright_limit": found["low"], "faint_limit": found["high"], "num_calib_stars": len(good), "num_outliers": n - len(good), "rmse_min": rmse.min(), "rmse_median": float(np.median(rmse)), "rmse_max": rmse.max(),
        "curve_mag": grid.tolist(), "curve_natmag": np.interp(grid, found["x"], found["y"]).tolist(), "curve_error": np.interp(grid, middles, rmse).tolist(),
    }
    return result, correction, lambda m: np.interp(m, middles, rmse)


def _in_batches(stars: DataFrame, groups: list[str], columns: list[str], key: str, schema: str, kernel: Callable[..., dict | None]) -> DataFrame:
    """As `_grouped`, for rows that have all columns, by mag and key: Spark sorts them, so that a task holds each column of a group once."""
    kinds = T.StructType([*stars.select(*groups).schema.fields, *T.StructType.fromDDL(schema).fields])
    known = stars.select(*groups, key, *(F.col(c).cast("double").alias(c) for c in columns)).where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in columns))
    arrow = to_arrow_schema(kinds)

    def fit(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gathered(batches, columns)
        found = kernel(*own) if len(own[0]) >= LEAST_STARS else None
        if found is not None:
            rest = [pa.array([None if isinstance(v := found[f.name], float) and v != v else v], f.type) for f in list(arrow)[len(groups) :]]
            yield pa.RecordBatch.from_arrays([*(pa.repeat(k, 1) for k in of), *rest], names=kinds.fieldNames())

    return known.repartition(*groups).sortWithinPartitions(*groups, "mag", key).groupBy(*groups).applyInArrow(fit, kinds)


def calibrated_solutions(stars: DataFrame, groups: list[str], key: str = "id") -> DataFrame:
    """The whole calibration of each group of stars: mag, bp, rp, x, y."""
    return _in_batches(stars, groups, ["mag", "bp", "rp", "x", "y"], key, RESULT, calibrated_solution)


SURFACE = "struct<degree:int,x_low:double,x_span:double,y_low:double,y_span:double,terms:array<double>>"
CORRECTED = RESULT + f", iterations int, surface {SURFACE}, bin_mags array<double>, bin_surfaces array<{SURFACE}>"


def _as_row(surface: Surface) -> dict:
    (x_low, x_span), (y_low, y_span) = ((float(a), float(b)) for a, b in surface.box)
    return {"degree": surface.degree, "x_low": x_low, "x_span": x_span, "y_low": y_low, "y_span": y_span, "terms": surface.terms.tolist()}


def corrected_solution(mag: np.ndarray, bp: np.ndarray, rp: np.ndarray, x: np.ndarray, y: np.ndarray, step: float = 0.1, rounds: int = 2) -> dict | None:
    """As `calibrated_solution`, the colour term and the curve of each round after the first freed of the correction, the term weighted by the errors
    that the round before has found; with the last round's correction as numbers. A round without a result leaves the one before."""
    best, corr, err = None, None, None
    for k in range(rounds):
        found = _calibrated(mag, bp, rp, x, y, step, corr, err)
        if found is None:
            break
        result, correction, error = found
        best = result | {"iterations": k + 1, "surface": None if correction.whole is None else _as_row(correction.whole), "bin_mags": [float(m) for m, _ in correction.bins], "bin_surfaces": [_as_row(s) for _, s in correction.bins]}
        corr, err = correction(x[:], y[:], mag[:]), error(mag[:])
    return best


def corrected_solutions(stars: DataFrame, groups: list[str], key: str = "id") -> DataFrame:
    """`corrected_solution` of each group of stars: mag, bp, rp, x, y."""
    return _in_batches(stars, groups, ["mag", "bp", "rp", "x", "y"], key, CORRECTED, corrected_solution)


def _polynomial(surface: Column, u: Column, v: Column) -> Column:
    """By powers of u, each with a polynomial of v, both from the highest power down."""

    def of(degree: int) -> Column:
        total, place = F.lit(0.0), {}
        for i in range(degree + 1):
            for j in range(degree + 1 - i):
                place[i, j] = len(place)
        for i in range(degree, -1, -1):
            row = F.lit(0.0)
            for j in range(degree - i, -1, -1):
                row = row * v + F.get(surface["terms"], F.lit(place[i, j]))
            total = total * u + row
        return total

    return F.when(surface["degree"] == 5, of(5)).when(surface["degree"] == 3, of(3))


def with_correction(rows: DataFrame, name: str, surface: Column, bin_mags: Column, bin_surfaces: Column, x: Column, y: Column, mag: Column) -> DataFrame:
    """The correction at a place and magnitude, 0 without a surface: that of the two bins' surfaces beside the magnitude is
    interpolated between their middles; beyond the first and the last middle theirs holds, as beyond the stars the value at their edge.

    Step by step in columns of their own, each of which is used more than once, so that the plan keeps them apart: all in one expression would
    be evaluated node by node."""
    c = F.col
    last = F.size(bin_mags) - 1
    out = rows.withColumn("_above", F.size(F.filter(bin_mags, lambda m: m <= mag)))  # the bin after the magnitude, from 0
    out = out.withColumns({"_left": F.greatest(c("_above") - 1, F.lit(0)), "_right": F.least(c("_above"), last)})
    share = F.coalesce(F.try_divide(mag - F.get(bin_mags, c("_left")), F.get(bin_mags, c("_right")) - F.get(bin_mags, c("_left"))), F.lit(0.0))
    out = out.withColumns({"_share": F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), "_at0": surface, "_at1": F.get(bin_surfaces, c("_left")), "_at2": F.get(bin_surfaces, c("_right"))})
    scaled = lambda v, low, span: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - low) / span)) * 2 - 1
    out = out.withColumns({f"_{n}{k}": scaled(w, c(f"_at{k}.{axis}_low"), c(f"_at{k}.{axis}_span")) for k in range(3) for n, axis, w in (("u", "x", x), ("v", "y", y))})
    for k in range(3):
        out = out.withColumn(f"_on{k}", _polynomial(c(f"_at{k}"), c(f"_u{k}"), c(f"_v{k}")))
    whole, lower, upper, inner = c("_on0"), c("_on1"), c("_on2"), c("_share")
    value = F.when(whole.isNull(), 0.0).when(F.size(bin_mags) <= 0, whole).when(lower.isNull() | upper.isNull(), 0.0).otherwise(whole + (lower * (1 - inner) + upper * inner))
    return out.withColumn(name, value).drop("_above", "_left", "_right", "_share", *(f"_{n}{k}" for n in ("at", "u", "v", "on") for k in range(3)))


def curve_value(mags: Column, values: Column, mag: Column) -> Column:
    """A curve sampled at even steps, its first and last segments extended."""
    first, last, n = F.get(mags, F.lit(0)), F.element_at(mags, -1), F.size(mags)
    step = (last - first) / (n - 1)
    k = F.greatest(F.lit(0), F.least(F.floor((mag - first) / step).cast("int"), n - 2))
    a, b = F.get(values, k), F.get(values, k + 1)
    return a + (mag - first - k * step) * (b - a) / step


def corrected_magnitudes(sources: DataFrame, solutions: DataFrame, groups: list[str]) -> DataFrame:
    """`sources` (groups, mag, x, y, bp_rp) with natmag_plate, natmag_correction, natmag, natmag_error, color_term, rpmag, bpmag and their
    errors, phot_range_flag (1 brighter, 2 fainter than the stars of the curve), from `solutions` (of corrected_solutions).

    One join; the rest are column expressions. Sources of 90 mag or more, and those without a solution, have null and flag 0."""
    c = F.col
    wanted = ("surface", "bin_mags", "bin_surfaces", "curve_mag", "curve_natmag", "curve_error", "bright_limit", "faint_limit")
    row = solutions.select(*groups, F.struct(*wanted).alias("_s"), "color_term", "color_term_error")
    joined = with_group(sources.withColumn("_m", F.when(c("mag") < 90, c("mag"))), row, groups, "left")
    held = F.least(F.greatest(c("_m"), c("_s.bright_limit")), c("_s.faint_limit"))
    curve = curve_value(c("_s.curve_mag"), c("_s.curve_natmag"), c("_m"))
    corrected = with_correction(joined, "natmag_correction", c("_s.surface"), c("_s.bin_mags"), c("_s.bin_surfaces"), c("x"), c("y"), c("_m")).withColumn("natmag_plate", curve)
    correction = F.when(c("natmag_plate").isNotNull(), c("natmag_correction"))
    out = corrected.withColumns({"natmag_correction": correction, "natmag_error": curve_value(c("_s.curve_mag"), c("_s.curve_error"), held), "phot_range_flag": F.when(c("_m") < c("_s.bright_limit"), 1).when(c("_m") > c("_s.faint_limit"), 2).otherwise(0)})
    error = F.sqrt(F.pow("natmag_error", 2) + F.pow(c("color_term_error") * c("bp_rp"), 2))
    out = out.withColumn("natmag", c("natmag_plate") + c("natmag_correction"))
    return out.withColumns({"rpmag": c("natmag") - c("color_term") * c("bp_rp"), "bpmag": c("natmag") - (c("color_term") - 1) * c("bp_rp"), "rpmag_error": error, "bpmag_error": error}).drop("_s", "_m")


#: A catalogue is deep enough so far below the plate's limit, or at this magnitude plus the colour term; the first depth is at most CEILING.
MARGIN, DEEPEST, CEILING = 0.7, 19.0, 15.0


def adaptive_depth(first: DataFrame, calibrate: Callable[[DataFrame], DataFrame], plate: str) -> DataFrame:
    """Deepen the catalogue of each plate until it reaches beyond the plate's faint limit; plate, limit, rounds, faint_limit.

    first: plate, faint_limit, estimate (the limit that the curve gives to the plate's faintest sources) and color_term of a
    preliminary calibration. `calibrate` takes the open plates with low and high, the magnitudes to be queried, and
    returns faint_limit, estimate and color_term of those it could calibrate. All open plates go through a round together; a
    round makes each catalogue deeper, by 2 magnitudes at most, so the rounds end at DEEPEST plus the colour term."""
    c = F.col
    most = F.lit(DEEPEST) + c("color_term")
    near = c("estimate") < c("faint_limit") + 2
    start = F.least(F.when(near, c("estimate") + 1).otherwise((c("faint_limit") + c("estimate")) / 2 + 1), F.lit(CEILING))
    state = checkpointed(first.select(plate, "faint_limit", "estimate", "color_term", most.alias("most"), F.lit(0.0).alias("low"), start.alias("high"), F.lit(0.0).alias("limit"), F.lit(0).alias("rounds")))
    done = None
    while True:
        is_open = (c("high") > c("limit")) & (c("limit") < c("faint_limit") + MARGIN) & (c("limit") < c("most"))
        closed = state.filter(~F.coalesce(is_open, F.lit(False)))
        done = closed if done is None else done.unionByName(closed)
        left = state.filter(is_open)
        if left.isEmpty():
            return checkpointed(done.select(plate, "limit", "rounds", "faint_limit"))
        got = calibrate(left.select(plate, "low", "high")).select(plate, c("faint_limit").alias("f"), c("estimate").alias("e"))
        joined = left.join(got, plate, "left").withColumns({"limit": c("high"), "rounds": c("rounds") + 1})
        deeper = F.when(c("e") < c("f") + 2, c("e") + 1).otherwise(F.least((c("f") + F.least("e", "most")) / 2 + 1, c("limit") + 2))
        # Without a calibration, or if it would not be deeper, a plate is done.
        following = F.when(deeper > c("limit"), F.least(deeper, c("most")))
        state = checkpointed(joined.select(plate, F.coalesce("f", "faint_limit").alias("faint_limit"), F.coalesce("e", "estimate").alias("estimate"), "color_term", "most", c("limit").alias("low"), F.coalesce(following, "limit").alias("high"), "limit", "rounds"))
