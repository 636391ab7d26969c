"""Star catalogues clustered by HEALPix number, and reads that touch only the part of the sky they ask for.

`write_clustered` stores a catalogue in directories of coarse pixels, sorted by fine pixel within. A cone becomes a few ranges of
fine numbers (a cover at mixed orders: large pixels that lie within, small ones along its rim), which reach the scan as a
partition filter and as pushed-down filters on row groups. What lies in a cover but not in the cone goes by exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import sky
from skyledger.operators import catalog
from skyledger.operators.solutions import pixel_centres

#: Order of the fine pixels that rows are sorted by (a minute of arc), and of the directories.
ORDER, SHELF_ORDER = 12, 3
#: Ranges of a cover at most: beyond it those with the smallest gaps are joined.
RANGES = 48
#: Milliarcseconds a year that no star's motion exceeds (the fastest one known has 10,400).
FASTEST = 10_500.0


class Field(NamedTuple):
    """A solution's field: centre and half diagonal in degrees, reference pixel, matrix in degrees a pixel, size in pixels."""

    number: int
    ra: float
    dec: float
    half_diagonal: float
    crpix: tuple[float, float]
    cd: tuple[float, float, float, float]
    width: float
    height: float


def mixed_cover(ra: float, dec: float, radius: float, order: int) -> list[tuple[int, int]]:
    """(level, pixel) that together hold every point nearer than `radius` degrees: pixels that lie within as large as they come, and
    those of the rim at the finest level (`order`, or that of an eighth of the radius)."""
    a, d, r = math.radians(ra), math.radians(dec), math.radians(min(max(radius, 0.0), 180.0))
    middle = np.array((math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)))
    finest = min(order, max(0, math.ceil(math.log2(9.6 / max(r, 1e-9)))))
    pixels, out = np.arange(12), []
    for level in range(finest + 1):
        if level:
            pixels = (pixels[:, None] * 4 + np.arange(4)).ravel()
        away = np.arccos(np.clip(pixel_centres(pixels, level) @ middle, -1, 1))
        bound = 1.2 / (1 << level)  # no part of a pixel is farther from its centre
        pixels, away = pixels[near := away <= r + bound], away[near]
        whole = (away + bound <= r) | (level == finest)
        out += [(level, int(p)) for p in pixels[whole]]
        pixels = pixels[~whole]
    return out


def cone_ranges(ra: float, dec: float, radius: float, order: int = ORDER, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges (first, last) of pixels of one order that hold a cone, ascending, `most` at most."""
    found: list[list[int]] = []
    for a, b in sorted((p << 2 * (order - level), (p + 1 << 2 * (order - level)) - 1) for level, p in mixed_cover(ra, dec, radius, order)):
        if found and a <= found[-1][1] + 1:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    while len(found) > most:
        k = min(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1])
        found[k - 1][1] = found[k][1]
        del found[k]
    return [(a, b) for a, b in found]


def write_clustered(stars: DataFrame, path: str, ra: str = "ra", dec: str = "dec") -> None:
    """Store a catalogue with hpx (pixel of ORDER) in directories shelf (pixel of SHELF_ORDER), rows sorted by hpx."""
    placed = stars.withColumn("hpx", sky.healpix_nested(F.col(ra), F.col(dec), ORDER)).withColumn("shelf", F.shiftright("hpx", 2 * (ORDER - SHELF_ORDER)))
    placed.repartitionByRange("hpx").sortWithinPartitions("shelf", "hpx").write.mode("overwrite").partitionBy("shelf").parquet(path)


def near_cones(stars: DataFrame, cones: list[tuple[float, float, float]]) -> DataFrame:
    """Rows of a clustered catalogue in the covers of some cones (ra, dec, radius): a superset of the cones' rows."""
    ranges = [r for cone in cones for r in cone_ranges(*cone)]
    shift = 2 * (ORDER - SHELF_ORDER)
    shelves = sorted({s for a, b in ranges for s in range(a >> shift, (b >> shift) + 1)})
    fine = F.lit(False)
    for a, b in sorted(set(ranges)):
        fine = fine | F.col("hpx").between(a, b)
    return stars.where(F.col("shelf").isin(shelves) & fine) if ranges else stars.limit(0)


def reference_stars(stars: DataFrame, fields: list[Field], epoch: float, mag: str = "mag", low: float | None = None, high: float | None = None, catalogue_epoch: float = 2016.0) -> DataFrame:
    """Reference stars of some plates' fields at their epoch: the columns of `stars` with ra and dec moved there, solution_num, x_ref,
    y_ref. A star is in a field if it is nearer than the half diagonal to the centre and its pixel lies on the image.

    The covers are widened by what the fastest star moves in the years between, so no star is lost by reading first."""
    slack = abs(epoch - catalogue_epoch) * FASTEST / 3_600_000
    moved = catalog.at_epoch(near_cones(stars, [(f.ra, f.dec, f.half_diagonal + slack) for f in fields]).where(catalog.in_range(F.col(mag), low, high)), epoch, catalogue_epoch)

    def pixel(f: Field) -> Column:
        x, y = sky.cd_pixel(F.col("ra"), F.col("dec"), F.lit(f.ra), F.lit(f.dec), tuple(map(F.lit, f.crpix)), tuple(map(F.lit, f.cd)))
        inside = catalog.in_cone(F.col("ra"), F.col("dec"), f.ra, f.dec, f.half_diagonal) & (x > 0) & (x < f.width) & (y > 0) & (y < f.height)
        return F.when(inside, F.struct(F.lit(f.number).alias("n"), x.alias("x"), y.alias("y")))

    hits = moved.withColumn("_hit", F.explode(F.filter(F.array(*map(pixel, fields)), lambda h: h.isNotNull())))
    return hits.withColumns({"solution_num": F.col("_hit.n"), "x_ref": F.col("_hit.x"), "y_ref": F.col("_hit.y")}).drop("_hit")


def cone_pixels(rows: DataFrame, keys: list[str], order: int, ra: str = "ra", dec: str = "dec", radius: str = "radius") -> DataFrame:
    """keys, pixel: for each cone of a table the pixels of `order` in its cover, for equality joins with a catalogue's pixels."""
    schema = rows.select(*keys).schema.add("pixel", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, cone in enumerate(zip(*(batch.column(len(keys) + i).to_pylist() for i in range(3)))):
                if None in cone:
                    continue
                found = np.concatenate([np.arange(p << 2 * (order - level), p + 1 << 2 * (order - level)) for level, p in mixed_cover(*cone, order)])
                one = batch.select(range(len(keys))).take(pa.array(np.full(len(found), k)))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(found, pa.int64())], names=schema.names)

    return rows.select(*keys, *(F.col(c).cast("double").alias(f"_{c}") for c in (ra, dec, radius))).mapInArrow(run, schema)


class HealpixCone:
    """Table function: (level, pixel) of a cone's cover at mixed orders, from ra, dec and radius in degrees and the finest order."""

    def eval(self, ra: float, dec: float, radius: float, finest: int):
        if None not in (ra, dec, radius, finest):
            yield from mixed_cover(ra, dec, radius, finest)


#: Functions for SQL by name: arguments, kind of the result, expression.
SQL_FUNCTIONS = {
    "sky_separation": ("ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE", "DOUBLE", "degrees(2 * asin(least(1D, sqrt(power(sin(radians(dec2 - dec1) / 2), 2) + cos(radians(dec1)) * cos(radians(dec2)) * power(sin(radians(ra2 - ra1) / 2), 2)))))"),
    "sky_passband": ("rp DOUBLE, colour DOUBLE, term DOUBLE", "DOUBLE", "rp + round(term, 5) * colour"),
}


def register_functions(spark: SparkSession) -> None:
    """Make healpix_cone (a table function) and SQL_FUNCTIONS known to a session's SQL, for its own duration."""
    kind = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("pixel", T.LongType())])
    spark.udtf.register("healpix_cone", F.udtf(HealpixCone, returnType=kind, useArrow=True))
    for name, (arguments, result, expression) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {expression}")
