"""Star catalogue queries: cones, boxes, magnitude ranges, growth by unseen stars."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import sky


def passband(rp: Column, colour: Column, term: float) -> Column:
    """Magnitude in a plate's own band: RP + term * (BP - RP), the term rounded to five places."""
    return rp + F.lit(round(term, 5)) * colour


def in_range(mag: Column, low: float | None = None, high: float | None = None) -> Column:
    """low <= mag < high, bounds rounded to five places; 0 and 99 where none is given."""
    return (mag >= round(0.0 if low is None else low, 5)) & (mag < round(99.0 if high is None else high, 5))


def in_cone(ra: Column, dec: Column, ra0: float, dec0: float, radius: float) -> Column:
    """Nearer than `radius` degrees to a point; a declination band comes first, as scans can skip row groups by it."""
    band = dec.between(dec0 - radius, dec0 + radius)
    return band & (sky.separation(ra, dec, F.lit(ra0), F.lit(dec0)) < radius)


def in_box(ra: Column, dec: Column, ra0: float, dec0: float, half_width: float, half_height: float, inclusive: bool = False) -> Column:
    """Right ascension and declination box, half_width in degrees on the sky; a box that reaches a pole is a cap, and
    one that crosses the zero meridian wraps."""
    low, high = dec0 - half_height, dec0 + half_height
    over, under = (lambda c, v: c >= v, lambda c, v: c <= v) if inclusive else (lambda c, v: c > v, lambda c, v: c < v)
    if high >= 90.0:
        return over(dec, low)
    if low <= -90.0:
        return under(dec, high)
    reach = half_width / math.cos(math.radians(max(abs(low), abs(high))))
    if reach >= 180.0:
        return over(dec, low) & under(dec, high)
    west, east = (ra0 - reach) % 360.0, (ra0 + reach) % 360.0
    inside = over(ra, west) & under(ra, east) if west <= east else over(ra, west) | under(ra, east)
    return over(dec, low) & under(dec, high) & inside


@dataclass(frozen=True)
class Solution:
    """Centre and half diagonal (degrees) of one exposure's field."""

    number: int
    ra: float
    dec: float
    half_diagonal: float


def _apart(a: Solution, b: Solution) -> float:
    d1, d2, da = math.radians(a.dec), math.radians(b.dec), math.radians(b.ra - a.ra)
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin(da / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h))))


def query_fields(stars: DataFrame, solutions: list[Solution], mag: Column, low: float | None = None, high: float | None = None, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Stars of all fields in a magnitude range, with solution_num.

    Fields that lie nearer to each other than a mean field's diagonal are read in one cone about the first, tagged 0; else
    each has a cone and its own tag. The few solutions are constants of one scan, not a join.
    """
    spread = max((_apart(a, b) for a in solutions for b in solutions), default=0.0)
    mean = 2 * sum(s.half_diagonal for s in solutions) / len(solutions)
    chosen = stars.filter(in_range(mag, low, high))
    if len(solutions) == 1 or spread < mean:
        first = solutions[0]
        radius = max(_apart(first, s) + s.half_diagonal for s in solutions)
        return chosen.filter(in_cone(F.col(ra), F.col(dec), first.ra, first.dec, radius)).withColumn("solution_num", F.lit(0))
    tags = F.filter(F.array(*(F.when(in_cone(F.col(ra), F.col(dec), s.ra, s.dec, s.half_diagonal), s.number) for s in solutions)), lambda x: x.isNotNull())
    return chosen.withColumn("solution_num", F.explode(tags))


def generic_names(stars: DataFrame) -> DataFrame:
    """Band names to generic ones: g to mag, bp to mag1, rp to mag2, bp_rp to color_index."""
    return stars.withColumnsRenamed({"g": "mag", "bp": "mag1", "rp": "mag2", "bp_rp": "color_index"})


def append_unseen(catalogue: DataFrame, fresh: DataFrame, key: str = "source_id") -> DataFrame:
    """`catalogue` with the rows of `fresh` whose key it has not; columns missing on a side are null."""
    return catalogue.unionByName(fresh.join(catalogue.select(key), key, "left_anti"), allowMissingColumns=True)


def remaining(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Entries of a work queue that are not done."""
    return queue.join(done.select(key), key, "left_anti")


def at_epoch(stars: DataFrame, epoch: float, reference: float = 2016.0, ra: str = "ra", dec: str = "dec", pmra: str = "pmra", pmdec: str = "pmdec") -> DataFrame:
    """`stars` with positions moved from the reference epoch."""
    a, d = sky.proper_motion(F.col(ra), F.col(dec), F.col(pmra), F.col(pmdec), F.lit(epoch - reference))
    return stars.withColumns({ra: a, dec: d})


def gap_filled(stars: DataFrame, cell: str = "cell") -> DataFrame:
    """Fill magnitudes of sparse cells from a second catalogue.

    Columns b, v (first catalogue) and b2, v2 (second). A star is good if b and v are there and not both 10 or brighter. In
    a cell with at most 10 good stars and more candidates (b2 and v2 above 10) than good ones, candidates that are not
    good take b2 and v2.
    """
    from pyspark.sql.window import Window

    good = F.col("b").isNotNull() & F.col("v").isNotNull() & ~((F.col("b") <= 10) & (F.col("v") <= 10))
    candidate = F.coalesce((F.col("b2") > 10) & (F.col("v2") > 10), F.lit(False))
    w = Window.partitionBy(cell)
    marked = stars.withColumns({"_good": good, "_cand": candidate}).withColumns({"_goods": F.sum(F.col("_good").cast("int")).over(w), "_cands": F.sum(F.col("_cand").cast("int")).over(w)})
    fill = F.col("_cand") & ~F.col("_good") & (F.col("_goods") <= 10) & (F.col("_cands") > F.col("_goods"))
    return marked.withColumns({"b": F.when(fill, F.col("b2")).otherwise(F.col("b")), "v": F.when(fill, F.col("v2")).otherwise(F.col("v")), "filled": fill.cast("int")}).drop("_good", "_cand", "_goods", "_cands")
