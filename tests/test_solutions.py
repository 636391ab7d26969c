"""Footprints and centroids of solutions by plain numpy."""

import numpy as np
from pyspark.sql import functions as F
from skyledger.functions import sky
from skyledger.operators import solutions
from skyledger.plans.solution_queries import FOOTPRINT, plate_solutions
from tests.oracle import SF


def vector(ra, dec):
    a, d = np.radians(ra), np.radians(dec)
    return np.stack((np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)), -1)


def centres(order):
    return solutions.pixel_centres(np.arange(12 << 2 * order), order)


def test_centres_of_pixels(spark):
    for order in (0, 1, 4):
        x, y, z = centres(order).T
        assert np.allclose(x * x + y * y + z * z, 1)
        rows = spark.createDataFrame(list(zip(range(len(x)), np.degrees(np.arctan2(y, x)).tolist(), np.degrees(np.arcsin(z)).tolist(), strict=True)), "p long, ra double, dec double")
        assert rows.filter(F.col("p") != sky.healpix_nested(F.col("ra"), F.col("dec"), order)).count() == 0


def test_footprint_against_all_pixels(spark):
    order = 5
    corners = [F.struct(F.lit(a).alias("ra"), F.lit(b).alias("dec")) for a, b in FOOTPRINT]
    rows = spark.range(1).select("id", F.array(*corners).alias("corners")).union(spark.range(1, 2).select("id", F.array(*corners[::-1]).alias("corners")))
    got = {0: set(), 1: set()}
    for r in solutions.footprint_pixels(rows, ["id"], order).collect():
        got[r.id].add(r.pixel)
    at, v = centres(order), vector(*np.array(FOOTPRINT).T)
    sides = np.stack([at @ np.cross(v[k], v[(k + 1) % 4]) for k in range(4)])
    same = (sides > 0).all(axis=0) | (sides < 0).all(axis=0)
    want = set(np.flatnonzero(same & (at @ v.sum(axis=0) > 0)).tolist())  # without the antipodes
    assert len(want) > 100 and got == {0: want, 1: want}


def test_centroid_by_plain_search(spark):
    rows = solutions.parameters(plate_solutions(spark, SF)).select("c_custkey", (F.col("c_custkey") % 9).alias("plate"), "ra_icrs", "dec_icrs", "corners").filter("c_custkey < 60")
    got = {r.plate: r for r in solutions.centroid(rows, "plate", "c_custkey").collect()}
    by = {}
    for r in rows.collect():
        by.setdefault(r.plate, []).append(r)
    assert set(got) == set(by)
    for plate, own in by.items():
        at = vector(np.array([r.ra_icrs for r in own]), np.array([r.dec_icrs for r in own]))
        first = int((at @ (at.sum(axis=0) / np.linalg.norm(at.sum(axis=0)))).argmin())
        second = int((at @ at[first]).argmin())
        a, b = (np.array([vector(c.ra, c.dec) for c in own[k].corners]) for k in (first, second))
        p, q = np.unravel_index((a @ b.T).argmin(), (4, 4))
        middle = a[p] + b[q]
        assert np.allclose(vector(got[plate].ra_centroid, got[plate].dec_centroid), middle / np.linalg.norm(middle), atol=1e-7)
        assert abs(got[plate].radius - np.degrees(np.arccos((a @ b.T).min())) / 2) < 1e-6 and abs(got[plate].max_separation - np.degrees(np.arccos(at[first] @ at[second]))) < 1e-6
