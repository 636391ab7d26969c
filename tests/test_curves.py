"""Smooth curves against plain versions and planted truths."""

import numpy as np
from skyledger.operators import calibration, fits


def plain_lowess(x, y, k, rounds):
    """Cleveland's curve point by point, without interpolation: weighted lines by lstsq."""
    robust = np.ones(len(x))
    for step in range(rounds + 1):
        fitted = np.empty(len(x))
        for i in range(len(x)):
            far = np.abs(x - x[i])
            near = np.argsort(far, kind="stable")[:k]
            u = far[near] / far[near].max()
            w = np.sqrt(np.where(u < 0.999, (1 - u**3) ** 3, 0) * robust[near])
            m = np.stack([np.ones(k), x[near] - x[i]], 1)
            fitted[i] = np.linalg.lstsq(m * w[:, None], y[near] * w, rcond=None)[0][0]
        rest = np.abs(y - fitted)
        scale = 6 * np.median(rest)
        robust = np.where(rest < 0.999 * scale, (1 - np.minimum(rest / scale, 1) ** 2) ** 2, 0.0)
    return fitted


def test_lowess_of_a_curve_with_outliers():
    rng = np.random.default_rng(3)
    x = np.sort(rng.uniform(0, 10, 150))
    y = np.sin(x) + rng.normal(0, 0.1, 150)
    y[::15] += 3
    for rounds in (0, 3):
        assert np.allclose(fits.lowess(x, y, 0.2, rounds), plain_lowess(x, y, 30, rounds), atol=1e-6)
    assert np.abs(fits.lowess(x, y, 0.2, 3) - np.sin(x)).max() < 0.25


def test_scanner_pattern_is_found(spark):
    rng = np.random.default_rng(4)
    rows = []
    for plate, size in (("wavy", 0.5), ("flat", 0.0)):
        x = rng.uniform(300, 9500, 3000)
        rows += [(plate, k, float(a), float(size * np.sin(a / 500) + e)) for k, (a, e) in enumerate(zip(x, rng.normal(0, 0.1, 3000)))]
    rows += [("few", k, 1.0 * k, 0.0) for k in range(3)] + [("wavy", 9999, None, 1.0)]
    found = calibration.scanner_pattern(spark.createDataFrame(rows, "plate string, id long, x double, residual double"), "plate", "x", "residual", 10000.0, "id").collect()
    curves = {p: sorted((r.position, r.value, r.extrapolated, r.strength) for r in found if r.plate == p) for p in ("wavy", "flat", "few")}
    assert curves["few"] == [] and [c[0] for c in curves["wavy"]] == list(np.arange(0, 10001, 50.0))
    inner = [(at, value) for at, value, beyond, _ in curves["wavy"] if not beyond and 400 < at < 9400]
    assert np.abs([v - 0.5 * np.sin(a / 500) for a, v in inner]).max() < 0.12
    assert {at for at, _, beyond, _ in curves["wavy"] if beyond} >= {0.0, 50.0, 9600.0, 10000.0} and not any(beyond for at, _, beyond, _ in curves["wavy"] if 400 < at < 9400)
    assert curves["wavy"][0][3] > 2 and curves["flat"][0][3] < 0.5


def test_lowess_of_counted_points_is_that_of_repeated_ones():
    rng = np.random.default_rng(5)
    for many in (1, 4, 30):
        x = np.sort(rng.choice(200, 90, replace=False)).astype(float).repeat(rng.integers(1, 4, 90))
        y = (np.sin(x / 30) + rng.integers(0, 5, len(x)) / 5).round(3)
        x, y = x[(order := np.lexsort((y, x)))], y[order]
        times = rng.integers(1, many + 1, len(x))
        for share, rounds, delta in ((0.3, 3, 0.0), (0.3, 3, 7.0), (0.15, 0, 2.5), (1.0, 1, 0.0)):
            whole = fits.lowess(x.repeat(times), y.repeat(times), share, rounds, delta)
            assert np.allclose(fits.lowess_counted(x, y, times, share, rounds, delta).repeat(times), whole, rtol=0, atol=1e-9)


def test_alike_stars_reach_the_kernel_of_a_pattern_once(spark, monkeypatch):
    """Of 40,000 stars in 1,000 places and four residuals the kernel gets 4,000 rows, and the curve is that of all stars."""
    seen = spark.range(40_000).selectExpr("id % 3 AS plate", "id", "double(id % 1000 * 10) AS x", "sin(id % 1000 / 50) + id % 4 / 4 AS residual")
    rows = calibration.scanner_pattern(seen, "plate", "x", "residual", 10000.0, "id")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("_times") < plan.index("Range")
    assert rows.groupBy("plate").count().count() == 3
    own = sorted((r.x, r.id, r.residual) for r in seen.where("plate = 1").collect())
    at, value = np.array([r[0] for r in own]), np.array([r[2] for r in own])
    curve = fits.lowess(at, value, len(own) ** -0.5, 3, 5.0 * 2)
    found = sorted((r.position, r.value, r.strength) for r in rows.where("plate = 1").collect())
    assert np.allclose([r[1] for r in found], np.interp([r[0] for r in found], at, curve), rtol=0, atol=1e-9)
    want = np.interp(np.linspace(2000, 8000, 60), at, curve).std() / (value - curve).std()
    assert np.allclose([r[2] for r in found], want, rtol=1e-9)
