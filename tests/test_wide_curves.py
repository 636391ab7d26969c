"""Curves of many stars: sums by blocks, columns in files."""

import tracemalloc

import numpy as np
import pytest
from skyledger.operators import calibration, smooth


def stars(n, kind=0):
    rng = np.random.default_rng(8)
    x = rng.gamma(4, 2, n) if kind == 0 else rng.gamma(4, 2, n).round(1)
    y = 0.9 * x + rng.integers(-8, 9, n) / 40
    y[::50] += rng.uniform(0.2, 3, len(y[::50]))
    order = np.lexsort((y, x))
    return x[order], y[order]


@pytest.mark.parametrize("kind", [0, 1])
def test_sums_by_blocks_are_those_by_points(kind, monkeypatch):
    x, y = stars(6000, kind)
    want = smooth.curve_places(x, y, 0.2, 3, 0.1)
    monkeypatch.setattr(smooth, "WIDE", 50)
    made = []
    monkeypatch.setattr(smooth, "_Narrow", lambda *a: made.append(a))
    got = smooth.curve_places(x, y, 0.2, 3, 0.1)
    assert not made and (got[0] == want[0]).all() and np.allclose(got[1], want[1], rtol=0, atol=1e-10)


def test_columns_in_files_give_the_same_curve_and_hold_few_stars(monkeypatch):
    x, y = stars(60_000)
    want = calibration.calibrated_in_order(x, y)
    for name, value in (("HELD", 1000), ("PART", 2000), ("WIDE", 1000)):
        monkeypatch.setattr(calibration if name == "HELD" else smooth, name, value)
    a, b = smooth.Column(), smooth.Column()
    a.append(x)
    b.append(y)
    tracemalloc.start()
    got = calibration.calibrated_in_order(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got["good"] == want["good"]).all() and (got["low"], got["high"]) == (want["low"], want["high"])
    at = np.linspace(want["low"] - 1, want["high"] + 1, 50)
    assert np.allclose(np.interp(at, got["x"], got["y"]), np.interp(at, want["x"], want["y"]), rtol=0, atol=1e-10)
    assert np.allclose(got["error"](at), want["error"](at), rtol=0, atol=1e-10)
    # Tables of counts and of blocks don't grow with the stars.
    assert peak < 24e6


def test_far_off_is_the_running_median():
    import pandas as pd

    rng = np.random.default_rng(9)
    for spread in (0.01, 0.1, 0.5):
        rest = np.abs(rng.standard_t(2, 3000)) * spread
        local = 1.4826 * pd.Series(rest).rolling(50, center=True, min_periods=1).median().to_numpy()
        want = (rest > 1) | (rest > 3 * np.maximum(local, 0.02))
        assert (calibration.far_off(rest, 0, 3000) == want).all() and want.any()
        assert (calibration.far_off(rest[975:2025], 25, 1025) == want[1000:2000]).all()


def test_curves_of_groups_come_from_batches_in_order(spark):
    x, y = stars(3000)
    rows = [(g, None if k == 5 else float(a), float("nan") if k == 7 else float(b)) for g in ("p", None) for k, (a, b) in enumerate(zip(x, y))] + [("few", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "plate string, mag double, natmag double").repartition(7)
    found = calibration.calibration_curves(df, ["plate"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FlatMapGroupsInArrow" in plan
    got = sorted((r.plate or "", r.plate_mag, r.natmag, r.error, r.num_used, r.num_outliers) for r in found.collect())
    keep = np.ones(3000, bool)
    keep[[5, 7]] = False
    want = calibration.calibrated(x[keep], y[keep])
    assert {g[0] for g in got} == {"", "p"} and {g[4] for g in got} == {int((~want["outlier"]).sum())} and {g[5] for g in got} == {int(want["outlier"].sum())}
    assert np.allclose([g[2] for g in got], np.interp([g[1] for g in got], want["x"], want["y"]), atol=1e-9)
    assert np.allclose([g[3] for g in got], want["error"](np.array([g[1] for g in got])), atol=1e-9)


def test_curves_are_made_once_for_their_application(spark):
    x, y = stars(500)
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(x, y)], "plate int, mag double, natmag double")
    rows = df.select("plate", "mag").selectExpr("*", "0D AS magerr", "1D AS color", "0.4D AS color_term", "0D AS natmag_correction")
    done = calibration.applied(rows, calibration.calibration_curves(df, ["plate"]), "plate")
    assert "FlatMapGroups" not in done._jdf.queryExecution().optimizedPlan().toString()
    found, at = calibration.calibrated(x, y), [(r.mag, r.natmag) for r in done.collect()]
    assert len(at) == 500 and np.allclose([n for m, n in at if 5 < m < 10], np.interp([m for m, _ in at if 5 < m < 10], found["x"], found["y"]), atol=0.02)


def test_a_vee_is_fitted_at_many_places_at_once(monkeypatch):
    """The best place to 1e-8 as by least squares at every place, in a few calls."""
    from skyledger.operators import photometry

    x = np.arange(45) * 0.25 - 4
    rng, calls, old = np.random.default_rng(10), [], np.linalg.qr
    for planted in (-2.2, 0.513, 4.9):
        y = 0.3 * np.abs(x - planted) + 0.01 * (x - planted) ** 2 + 0.05 + rng.normal(0, 1e-3, 45)
        rest = lambda at: float(np.linalg.lstsq(np.stack((np.abs(x - at), (x - at) ** 2, np.ones(45)), -1), y, rcond=None)[1][0])  # noqa: E731, B023
        monkeypatch.setattr(np.linalg, "qr", lambda *a, **k: calls.append(1) or old(*a, **k))
        (x0, a, _, _), _ = photometry.vee_fit(x, y)
        monkeypatch.setattr(np.linalg, "qr", old)
        assert abs(x0 - planted) < 0.02 and abs(a - 0.3) < 0.01
        assert all(rest(x0) <= rest(at) + 1e-15 for at in np.linspace(x0 - 0.3, x0 + 0.3, 301))
    assert 0 < len(calls) < 40


def test_a_solution_is_the_same_from_columns_in_files(monkeypatch):
    from skyledger.operators import photometry

    rng, n = np.random.default_rng(11), 4000
    mag = np.sort(rng.uniform(5, 15, n))
    colour, x, y = rng.uniform(0, 2, n), rng.uniform(0, 1e4, n), rng.uniform(0, 8e3, n)
    nat = mag * 1.05 + 2 + rng.normal(0, 0.03, n) + x / 1e5
    own = [mag, nat + 0.5 * colour, nat - 0.5 * colour, x, y]
    for f in (photometry.calibrated_solution, photometry.corrected_solution):
        want, files = f(*own), []
        with monkeypatch.context() as m:
            m.setattr(calibration, "HELD", 500)
            for v in own:
                files.append(smooth.Column())
                files[-1].append(v)
            got = f(*files)
        assert want is not None and want.keys() == got.keys() and want["num_outliers"] == got["num_outliers"]
        assert all(np.allclose(got[k], want[k], rtol=0, atol=1e-9, equal_nan=True) for k in want if k not in ("surface", "bin_surfaces"))
