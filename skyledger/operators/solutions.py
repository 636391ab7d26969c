"""Astrometric solutions of plates: their parameters, validity, uniqueness, footprints, and statistics over a plate.

A solution is a row with ra_icrs, dec_icrs, crpix1, crpix2, cd1_1, cd1_2, cd2_1, cd2_2 (gnomonic projection, degrees a pixel),
imwidth and imheight. A plate has a handful of solutions, so arrays of a plate's solutions are bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import sky, text

#: A field of view narrower than this (degrees), or an aspect this far off the image's, is no solution.
LEAST_FOV, ASPECT = 1e-3, (0.95, 1.05)
#: Solutions nearer than so many pixels are one.
APART = 10.0


def _wcs() -> tuple[Column, Column, tuple[Column, Column], tuple[Column, Column, Column, Column]]:
    c = F.col
    return c("ra_icrs"), c("dec_icrs"), (c("crpix1"), c("crpix2")), (c("cd1_1"), c("cd1_2"), c("cd2_1"), c("cd2_2"))


def _sky_at(x: Column, y: Column) -> Column:
    ra, dec = sky.cd_sky(x, y, *_wcs())
    return F.struct(ra.alias("ra"), dec.alias("dec"))


def _apart(a: Column, b: Column) -> Column:
    return sky.separation(a["ra"], a["dec"], b["ra"], b["dec"])


def fields_of_view(rows: DataFrame) -> DataFrame:
    """`rows` with fov1 and fov2 (degrees): distances of the middles of opposite edges."""
    w, h, one = F.col("imwidth").cast("double"), F.col("imheight").cast("double"), F.lit(1.0)
    middle = lambda v: (v + 1) / 2
    edges = F.array(_sky_at(one, middle(h)), _sky_at(w, middle(h)), _sky_at(middle(w), one), _sky_at(middle(w), h))
    at = rows.withColumn("_edges", edges)
    edge = lambda k: F.get("_edges", F.lit(k))
    return at.withColumns({"fov1": _apart(edge(0), edge(1)), "fov2": _apart(edge(2), edge(3))}).drop("_edges")


def valid_solutions(rows: DataFrame) -> DataFrame:
    """`rows` with fov1, fov2 and valid: a field of view on both axes, with the image's aspect."""
    ratio = F.try_divide(F.col("fov1") * F.col("imheight"), F.col("fov2") * F.col("imwidth"))
    good = (F.col("fov1") >= LEAST_FOV) & (F.col("fov2") >= LEAST_FOV) & (ratio > ASPECT[0]) & (ratio < ASPECT[1])
    return fields_of_view(rows).withColumn("valid", F.coalesce(good, F.lit(False)))


def parameters(rows: DataFrame, num_sources: str = "num_sources", rel_area: str = "rel_area") -> DataFrame:
    """`rows` with fields of view, pixel_scale (arcseconds), half_diag, source_density (a square degree), poles near and on the
    plate, corners, regions, rotation_angle (north, clockwise from the image's y axis, -180 to 180) and plate_mirrored."""
    c, (ra0, dec0, crpix, cd) = F.col, _wcs()
    w, h, one = c("imwidth").cast("double"), c("imheight").cast("double"), F.lit(1.0)
    out = fields_of_view(rows).withColumns(
        {
            "pixel_scale": (c("fov1") / w + c("fov2") / h) * 1800.0,
            "half_diag": F.sqrt(c("fov1") * c("fov1") + c("fov2") * c("fov2")) / 2,
            "source_density": F.try_divide(c(num_sources).cast("double"), c(rel_area) * c("fov1") * c("fov2")),
            "corners": F.array(_sky_at(one, one), _sky_at(w, one), _sky_at(w, h), _sky_at(one, h)),
        }
    )

    def on_plate(pole: float) -> Column:
        x, y = sky.cd_pixel(ra0, F.lit(pole), ra0, dec0, crpix, cd)
        return F.coalesce((x > 0) & (x < w) & (y > 0) & (y < h), F.lit(False))

    near = {"ncp": F.lit(90.0) - dec0 <= c("half_diag"), "scp": F.lit(90.0) + dec0 <= c("half_diag")}
    out = out.withColumns({f"{k}_close": v for k, v in near.items()} | {f"{k}_on_plate": v & on_plate(p) for (k, v), p in zip(near.items(), (90.0, -90.0), strict=True)})

    def direction(ra: Column, dec: Column) -> Column:
        """Degrees clockwise from the y axis, 0 to 360, of the way to a position."""
        x, y = sky.cd_pixel(ra, dec, ra0, dec0, crpix, cd)
        return sky.modulo(F.lit(90.0) - F.degrees(F.atan2(y - crpix[1], x - crpix[0])), 360.0)

    out = out.withColumns({"_north": direction(ra0, F.when(dec0 > 89, 90.0).otherwise(dec0 + 1)), "_east": direction(F.when(ra0 > 359, ra0 - 359).otherwise(ra0 + 1), dec0)})
    return out.withColumns(
        {
            "rotation_angle": F.when(c("_north") > 180, c("_north") - 360).otherwise(c("_north")),
            "plate_mirrored": sky.modulo(c("_north") - c("_east"), 360.0) > 180,
            "stc_box": text.box_region(ra0, dec0, c("fov1"), c("fov2")),
            "stc_polygon": text.polygon_region(c("corners")),
        }
    ).drop("_north", "_east")


def numbered(rows: DataFrame, plate: str, order: str) -> DataFrame:
    """`rows` with solution_num and unique_num. In order, a solution at least APART of its pixels (pixel_scale, arcseconds) away
    from all unique ones so far gets the next number; others get -1, -2 and so on, and the number of the nearest unique one."""
    each = F.struct(F.col(order).alias("at"), F.struct(*rows.columns).alias("row"))
    solutions = rows.groupBy(plate).agg(F.sort_array(F.collect_list(each)).alias("_all"))
    kind = "struct<uniques:array<struct<ra:double,dec:double>>,out:array<struct<num:int,of:int>>>"

    def step(state: Column, x: Column) -> Column:
        row, uniques, out = x["row"], state["uniques"], state["out"]
        away = F.transform(uniques, lambda u: sky.separation(row["ra_icrs"], row["dec_icrs"], u["ra"], u["dec"]))
        fresh = ~F.coalesce(F.array_min(away) < row["pixel_scale"] * F.lit(APART / 3600), F.lit(False))
        nearest = F.array_position(away, F.array_min(away)).cast("int")
        num = F.when(fresh, F.size(uniques) + 1).otherwise(F.size(uniques) - F.size(out) - 1)
        place = F.array(F.struct(row["ra_icrs"].cast("double").alias("ra"), row["dec_icrs"].cast("double").alias("dec")))
        return F.struct(F.when(fresh, F.concat(uniques, place)).otherwise(uniques).alias("uniques"), F.concat(out, F.array(F.struct(num.cast("int").alias("num"), F.when(~fresh, nearest).alias("of")))).alias("out")).cast(kind)

    start = F.struct(F.array().cast("array<struct<ra:double,dec:double>>").alias("uniques"), F.array().cast("array<struct<num:int,of:int>>").alias("out")).cast(kind)
    numbers = F.aggregate("_all", start, step, lambda s: s["out"])
    return solutions.select(F.explode(F.arrays_zip(F.col("_all").alias("s"), numbers.alias("n"))).alias("z")).select(*(F.col("z.s.row")[c].alias(c) for c in rows.columns), F.col("z.n.num").alias("solution_num"), F.col("z.n.of").alias("unique_num"))


def plate_statistics(rows: DataFrame, plate: str) -> DataFrame:
    """Per plate: number of solutions, mean, least and greatest pixel scale, mean fields of view and source density."""
    a = F.avg
    return rows.groupBy(plate).agg(F.count(F.lit(1)).alias("num_solutions"), a("pixel_scale").alias("mean_pixel_scale"), F.min("pixel_scale").alias("min_pixel_scale"), F.max("pixel_scale").alias("max_pixel_scale"), a("fov1").alias("mean_fov1"), a("fov2").alias("mean_fov2"), a("source_density").alias("source_density"))


def plate_limits(calibrations: DataFrame, plate: str) -> DataFrame:
    """Per plate, over its calibrated solutions: faintest and brightest limits, mean colour term, and that weighted by stars."""
    weighted = F.try_divide(F.sum(F.col("color_term") * F.col("cterm_num_stars")), F.sum("cterm_num_stars"))
    return calibrations.groupBy(plate).agg(F.min("bright_limit").alias("bright_limit"), F.max("faint_limit").alias("faint_limit"), F.avg("color_term").alias("mean_color_term"), weighted.alias("color_term"))


def centroid(rows: DataFrame, plate: str, key: str) -> DataFrame:
    """Per plate: ra_centroid, dec_centroid, radius, max_separation. From the solution farthest from the middle of all and the
    one farthest from that, the two corners that lie farthest apart; the centroid is half-way between them."""
    c = F.col
    x, y, z = sky.unit_vector(c("ra_icrs"), c("dec_icrs"))
    middle = rows.groupBy(c(plate).alias("m_plate")).agg(F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(z).alias("z"))
    m_ra, m_dec = sky.from_vector(c("x"), c("y"), c("z") / F.sqrt(c("x") * c("x") + c("y") * c("y") + c("z") * c("z")))
    seen = rows.join(middle.select("m_plate", m_ra.alias("m_ra"), m_dec.alias("m_dec")), c(plate) == c("m_plate"))
    own = F.struct(c("ra_icrs").alias("ra"), c("dec_icrs").alias("dec"), c("corners").alias("corners"))
    first = seen.groupBy("m_plate").agg(F.max_by(own, F.struct(sky.separation(c("m_ra"), c("m_dec"), c("ra_icrs"), c("dec_icrs")), -c(key))).alias("one"))
    pairs = rows.join(first, c(plate) == c("m_plate")).withColumn("sep", sky.separation(c("one.ra"), c("one.dec"), c("ra_icrs"), c("dec_icrs")))
    both = pairs.groupBy("m_plate").agg(F.first("one").alias("one"), F.max_by("corners", F.struct("sep", -c(key))).alias("others"), F.max("sep").alias("max_separation"))
    all_pairs = F.flatten(F.transform(c("one.corners"), lambda p: F.transform(c("others"), lambda q: F.struct(_apart(p, q).alias("sep"), p.alias("p"), q.alias("q")))))
    far = both.select(c("m_plate").alias(plate), "max_separation", F.array_max(all_pairs).alias("far"))
    p, q, half = c("far.p"), c("far.q"), c("far.sep") / 2
    ra, dec = sky.directional_offset(p["ra"], p["dec"], sky.position_angle(p["ra"], p["dec"], q["ra"], q["dec"]), half)
    return far.select(plate, ra.alias("ra_centroid"), dec.alias("dec_centroid"), half.alias("radius"), "max_separation")


# Rings of the faces' northern corners, and their centres in steps of an eighth turn (fixed values of the HEALPix scheme).
FACE_RING = np.array([2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4])
FACE_TURN = np.array([1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7])


def pixel_centres(pixels: np.ndarray, order: int) -> np.ndarray:
    """Unit vectors (n, 3) of the centres of HEALPix pixels of the nested scheme (Gorski et al. 2005)."""
    nside = 1 << order
    face, x, y = pixels >> 2 * order, np.zeros_like(pixels), np.zeros_like(pixels)
    for bit in range(order):
        x |= (pixels >> 2 * bit & 1) << bit
        y |= (pixels >> 2 * bit + 1 & 1) << bit
    ring = FACE_RING[face] * nside - x - y - 1
    polar = (ring < nside) | (ring > 3 * nside)
    count = np.where(ring < nside, ring, np.where(ring > 3 * nside, 4 * nside - ring, nside))
    z = np.where(polar, np.sign(2 * nside - ring) * (1 - count**2 / (3 * nside**2)), (2 * nside - ring) * 2 / (3 * nside))
    # Steps of half a pixel along the ring from the middle of the face.
    longitude = (FACE_TURN[face] * count + x - y) * np.pi / (4 * count)
    level = np.sqrt(1 - z * z)
    return np.stack((level * np.cos(longitude), level * np.sin(longitude), z), -1)


def pixels_inside(corners: np.ndarray, order: int) -> np.ndarray:
    """Pixels whose centres lie on the same side of the great circles through all edges of a polygon (ra, dec in degrees).

    From the twelve faces down, pixels too far from the polygon's middle to reach it go with all their parts."""
    a, d = np.radians(corners).T
    at = np.stack((np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)), -1)
    middle = at.sum(axis=0) / np.linalg.norm(at.sum(axis=0))
    reach = np.arccos(np.clip(at @ middle, -1, 1)).max()
    edges = np.cross(at, np.roll(at, -1, axis=0))
    pixels = np.arange(12)
    for level in range(order + 1):
        if level:
            pixels = (pixels[:, None] * 4 + np.arange(4)).ravel()
        # No part of a pixel is farther than this from its centre.
        far = np.arccos(np.clip(pixel_centres(pixels, level) @ middle, -1, 1)) > reach + 1.2 / (1 << level)
        pixels = pixels[~far]
    sides = pixel_centres(pixels, order) @ edges.T
    return pixels[(sides > 0).all(axis=1) | (sides < 0).all(axis=1)]


def footprint_pixels(rows: DataFrame, keys: list[str], order: int) -> DataFrame:
    """keys, pixel: HEALPix pixels (nested, nside 2 ** order) with centres inside the polygon of a solution's corners."""
    schema = rows.select(*keys).schema.add("pixel", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, own in enumerate(batch.column(len(keys)).to_pylist()):
                found = pixels_inside(np.array([(p["ra"], p["dec"]) for p in own]), order)
                one = batch.select(range(len(keys))).take(pa.array(np.full(len(found), k)))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(found, pa.int64())], names=[*keys, "pixel"])

    return rows.select(*keys, "corners").mapInArrow(run, schema)


def footprint_counts(pixels: DataFrame, sources: DataFrame, keys: list[str], pixel: str) -> DataFrame:
    """keys, pixel, num_sources, inside: sources by pixel, with zeros for a footprint's pixels that have none."""
    seen = sources.select(*keys, F.col(pixel).alias("pixel"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("in"))
    zeros = pixels.select(*keys, "pixel", F.lit(0).cast("long").alias("n"), F.lit(True).alias("in"))
    return zeros.unionByName(seen).groupBy(*keys, "pixel").agg(F.sum("n").alias("num_sources"), F.max("in").alias("inside"))


def matched_centroids(pairs: DataFrame, keys: list[str], width: Column, height: Column) -> DataFrame:
    """Per group of matched sources: their number, mean pixel position, and that as a share of the image."""
    x, y = F.avg("x_source"), F.avg("y_source")
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_matched"), x.alias("x_centroid"), y.alias("y_centroid"), (x / F.max(width)).alias("rel_x_centroid"), (y / F.max(height)).alias("rel_y_centroid"))


def pattern_corrected(sources: DataFrame, patterns: DataFrame, group: str, ratio: str = "pattern_ratio") -> DataFrame:
    """`sources` less the scanner's pattern: y where the ratio is above 1.5, x where it is below 2/3, else as they are.

    patterns: group, axis ('x' or 'y'), position, value; sources: group, x_source, y_source, ratio."""
    from skyledger.operators.fits import group_parts, interpolated

    out, parts = sources, group_parts(sources, group)
    for axis in ("x", "y"):
        curve = patterns.filter(F.col("axis") == axis).select(group, F.col("position").cast("double").alias("cx"), F.col("value").alias("cy"))
        out = interpolated(out, curve, group, f"{axis}_source", name=f"_{axis}", parts=parts)
    r = F.col(ratio)
    less = lambda when, axis: F.col(f"{axis}_source") - F.when(when, F.coalesce(f"_{axis}", F.lit(0.0))).otherwise(F.lit(0.0))
    return out.withColumns({"y_source": less(r > 1.5, "y"), "x_source": less(r < 2.0 / 3.0, "x")}).drop("_x", "_y")


def accepted_clusters(clusters: DataFrame, plate: str, size: str, numexp: str, least: int = 5) -> DataFrame:
    """Clusters of neighbours as large as the number of exposures within a tenth, of plates that have enough of them, by size."""
    fits = clusters.filter(F.abs(F.col(size) - F.col(numexp)) < F.lit(0.1) * F.col(numexp))
    enough = fits.groupBy(plate).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select(plate)
    return fits.join(enough, plate, "left_semi").orderBy(plate, F.col(size).desc())


def compact_clusters(members: DataFrame, keys: list[str], cluster: str, x: str, y: str, spread: float) -> DataFrame:
    """Clusters with their size, centre and deviations, and compact where neither deviation is above `spread`; largest first."""
    stats = members.groupBy(*keys, cluster).agg(F.count(F.lit(1)).alias("size"), F.avg(x).alias("x"), F.avg(y).alias("y"), F.stddev_pop(x).alias("x_std"), F.stddev_pop(y).alias("y_std"))
    return stats.withColumn("compact", F.greatest("x_std", "y_std") <= spread).orderBy(*keys, F.col("size").desc(), cluster)
