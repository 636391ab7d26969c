import numpy as np
from pyspark.sql import functions as F
from skyledger.functions import sky
from skyledger.plans.exposure_queries import CD, PV1, PV2


def test_terms_in_the_order_of_the_convention():
    terms = sky.tpv_terms()
    # Fixed values of the convention: numbers of some terms as powers of xi, eta, r.
    assert len(terms) == 40 and [terms[k] for k in (0, 1, 2, 3, 4, 5, 6, 7, 10, 11, 12, 16, 17, 22, 23, 24, 31, 38, 39)] == [
        (0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (2, 0, 0), (1, 1, 0), (0, 2, 0), (3, 0, 0), (0, 3, 0), (0, 0, 3), (4, 0, 0), (0, 4, 0), (5, 0, 0), (0, 5, 0), (0, 0, 5), (6, 0, 0), (7, 0, 0), (0, 7, 0), (0, 0, 7),
    ]


def test_pixels_there_and_back_over_the_field(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([tuple(map(float, v)) for v in np.stack([rng.uniform(0, 10000, 300), rng.uniform(0, 8000, 300)], 1)] + [(5000.0, 4000.0)], "x double, y double")
    for ra0, dec0 in ((310.0, 55.0), (0.2, -88.5), (120.0, 0.0)):
        at = (F.lit(ra0), F.lit(dec0), (F.lit(5000.0), F.lit(4000.0)), tuple(map(F.lit, CD)))
        for pv in ((PV1, PV2), ({3: 1e-4, 39: 1e-7}, {}), ({}, {})):
            ra, dec = sky.tpv_sky(F.col("x"), F.col("y"), *at, *pv)
            there = df.withColumns({"ra": ra, "dec": dec})
            x, y = sky.tpv_pixel(F.col("ra"), F.col("dec"), *at, *pv)
            worst = there.withColumns({"px": x, "py": y}).agg(F.max(F.abs(F.col("px") - F.col("x"))), F.max(F.abs(F.col("py") - F.col("y"))), F.count("px")).first()
            assert worst[0] < 1e-8 and worst[1] < 1e-8 and worst[2] == 301


def test_coefficients_of_each_row(spark):
    df = spark.createDataFrame([(0.5, -0.25, 1e-3, 1.0), (0.5, -0.25, 0.0, 2.0)], "u double, v double, c double, one double")
    xi, eta = sky.tpv_plane(F.col("u"), F.col("v"), {1: F.col("one"), 4: F.col("c")}, {4: F.col("c")})
    got = [tuple(r) for r in df.select(xi, eta).collect()]
    assert np.allclose(got, [(0.5 + 0.25e-3, -0.25 + 0.0625e-3), (1.0, -0.25)], atol=1e-15)


def test_no_place_to_be_found_is_null(spark):
    df = spark.createDataFrame([(-2.0, 0.1)], "a double, b double")
    # x + x^2 is nowhere -2.
    x, y = sky.undistorted(F.col("a"), F.col("b"), {(2, 0): 1.0}, {})
    assert tuple(df.select(x.alias("x"), y.alias("y")).first()) == (None, None)
    a, b = sky.undistorted(F.lit(30.0), F.lit(2.0), {(2, 0): 0.5, (0, 1): 0.1}, {(1, 1): 0.01})
    r = df.select(a.alias("x"), b.alias("y")).first()
    assert abs(r.x + 0.5 * r.x**2 + 0.1 * r.y - 30) < 1e-10 and abs(r.y + 0.01 * r.x * r.y - 2) < 1e-10
