import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from skyledger.functions import sky
from skyledger.operators import catalog, cover
from skyledger.plans import exposure_queries
from tests.oracle import SF

CONES = [(0.2, 1.0, 3.0), (180.0, 89.0, 5.0), (300.0, -60.0, 0.02), (77.0, 10.0, 40.0), (10.0, -90.0, 1.0)]


@pytest.fixture(scope="module")
def stars(spark):
    r = np.random.default_rng(2)
    n = 6000
    z = r.uniform(-1, 1, n)
    rows = [(i, float(a), float(d), float(m), float(p), float(q)) for i, (a, d, m, p, q) in enumerate(zip(r.uniform(0, 360, n), np.degrees(np.arcsin(z)), r.uniform(2, 16, n), r.uniform(-9000, 9000, n), r.uniform(-5000, 5000, n)))]
    rows += [(n + k, (ra + 0.01) % 360, min(dec + 0.005, 90.0), 9.0, None, None) for k, (ra, dec, _) in enumerate(CONES)]
    return spark.createDataFrame(rows, "id long, ra double, dec double, mag double, pmra double, pmdec double")


def test_ranges_hold_the_cone_and_little_else(spark, stars):
    placed = stars.withColumn("hpx", sky.healpix_nested(F.col("ra"), F.col("dec"), cover.ORDER)).cache()
    for ra, dec, radius in CONES:
        ranges = cover.cone_ranges(ra, dec, radius)
        assert 0 < len(ranges) <= cover.RANGES and all(a <= b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
        inside = placed.where(catalog.in_cone(F.col("ra"), F.col("dec"), ra, dec, radius))
        held = {r.hpx for r in inside.collect()}
        assert held and all(any(a <= h <= b for a, b in ranges) for h in held)
        area = 2 * np.pi * (1 - np.cos(np.radians(radius)))
        assert sum(b - a + 1 for a, b in ranges) * 4 * np.pi / (12 << 2 * cover.ORDER) < 4 * area
    assert cover.cone_ranges(5.0, 5.0, 180.0) == [(0, (12 << 2 * cover.ORDER) - 1)]


def test_scan_reads_the_cone_alone(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    cover.write_clustered(stars, path)
    table = spark.read.parquet(path)
    near = cover.near_cones(table, [(300.0, -60.0, 1.0)])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*shelf#\d+ (IN|=)", plan) and re.search(r"PushedFilters: \[Or\(", plan)
    files = {r[0] for r in near.select(F.input_file_name()).distinct().collect()}
    assert len(files) <= 3 < len(table.inputFiles()) / 10
    # Rows of the cones are those of the whole table.
    whole = {r.id for r in stars.where(catalog.in_cone(F.col("ra"), F.col("dec"), 77.0, 10.0, 40.0)).collect()}
    assert {r.id for r in cover.near_cones(table, [(77.0, 10.0, 40.0)]).where(catalog.in_cone(F.col("ra"), F.col("dec"), 77.0, 10.0, 40.0)).collect()} == whole
    assert cover.near_cones(table, []).count() == 0


def test_fast_stars_come_into_the_field(spark, stars, tmp_path):
    path, epoch = str(tmp_path / "stars"), 1890.0
    cover.write_clustered(stars, path)
    field = cover.Field(7, 45.0, 30.0, 14.0, (5000.0, 5000.0), (-0.002, 0.0, 0.0, 0.002), 10000.0, 10000.0)
    got = {(r.id, r.solution_num): (r.ra, r.dec) for r in cover.reference_stars(spark.read.parquet(path), [field, field._replace(number=8)], epoch).collect()}
    moved = catalog.at_epoch(stars, epoch)
    x, y = sky.cd_pixel(F.col("ra"), F.col("dec"), F.lit(45.0), F.lit(30.0), (F.lit(5000.0),) * 2, tuple(map(F.lit, field.cd)))
    want = {r.id: (r.ra, r.dec) for r in moved.where(catalog.in_cone(F.col("ra"), F.col("dec"), 45.0, 30.0, 14.0) & x.between(0, 10000) & y.between(0, 10000)).collect()}
    assert want and got == {(i, n): p for i, p in want.items() for n in (7, 8)}


def test_pixels_of_cones_join_with_stars(spark, stars):
    cones = spark.createDataFrame([(k, *c) for k, c in enumerate(CONES)] + [(99, None, 1.0, 1.0)], "cone long, ra double, dec double, radius double")
    pixels = cover.cone_pixels(cones, ["cone", "radius"], 5)
    placed = stars.withColumn("pixel", sky.healpix_nested(F.col("ra"), F.col("dec"), 5))
    joined = pixels.join(cones.select("cone", F.col("ra").alias("a"), F.col("dec").alias("d")), "cone").join(placed, "pixel").where(sky.separation(F.col("ra"), F.col("dec"), F.col("a"), F.col("d")) < F.col("radius"))
    got = {(r.cone, r.id) for r in joined.collect()}
    want = {(k, r.id) for k, c in enumerate(CONES) for r in stars.where(sky.separation(F.col("ra"), F.col("dec"), F.lit(c[0]), F.lit(c[1])) < c[2]).collect()}
    assert got == want
    assert exposure_queries.reference_read(spark, SF).columns == ["id", "solution_num", "mag", "x_ref", "y_ref"]


def test_functions_for_sql(spark):
    cover.register_functions(spark)
    rows = spark.sql("SELECT level, pixel FROM healpix_cone(77D, 10D, 40D, 5) ORDER BY ALL").collect()
    assert sorted(map(tuple, rows)) == sorted(cover.mixed_cover(77.0, 10.0, 40.0, 5)) and len({r.level for r in rows}) > 1
    a = spark.sql("SELECT sky_separation(10D, 20D, 15D, -3D) AS s, sky_passband(10D, 2D, 0.123456D) AS m, (SELECT count(*) FROM healpix_cone(NULL, 1D, 1D, 3)) AS n").first()
    assert a.n == 0 and a.m == 10 + 0.12346 * 2
    assert abs(a.s - spark.range(1).select(sky.separation(F.lit(10.0), F.lit(20.0), F.lit(15.0), F.lit(-3.0))).first()[0]) < 1e-12
