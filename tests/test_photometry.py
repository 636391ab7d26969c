"""Kernels of the calibration against plain numpy versions and known truths."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from skyledger.operators import photometry as ph
from skyledger.operators.fits import lowess


def stars(n, term, seed=1, noise=0.03):
    rng = np.random.default_rng(seed)
    rp, colour = rng.uniform(8, 15, n), rng.uniform(0.2, 2.5, n)
    nat = rp + term * colour
    mag = (nat - 20) * 0.8 + 0.02 * (nat - 12) ** 2 + rng.normal(0, noise, n)
    return mag, rp + colour, rp


def test_vee_fit():
    x = ph.COARSE
    rng = np.random.default_rng(2)
    for want in ((0.62, 0.3, 0.05, 0.1), (-1.3, 0.8, -0.01, 0.2), (2.01, 0.1, 0.2, 0.0)):
        x0, a, b, c = want
        exact = a * np.abs(x - x0) + b * (x - x0) ** 2 + c
        assert np.allclose(ph.vee_fit(x, exact)[0], want, atol=1e-5)
        noisy = exact + rng.normal(0, 0.01, len(x))
        got, error = ph.vee_fit(x, noisy)
        # No better sum of squares on a fine grid of all four, around the fit
        rest = lambda p: ((noisy - p[1] * np.abs(x - p[0]) - p[2] * (x - p[0]) ** 2 - p[3]) ** 2).sum()
        assert all(rest(got) <= rest(got + d) + 1e-12 for d in rng.normal(0, 0.003, (400, 4)))
        assert (error > 0).all() and abs(got[0] - x0) < 6 * error[0]


def test_weighted_parabola():
    rng = np.random.default_rng(3)
    x = np.linspace(-1, 1, 41)
    y, w = 2 * x**2 - x + 0.5 + rng.normal(0, 0.01, 41), rng.uniform(0.5, 2, 41)
    got, error = ph.weighted_parabola(x, y, w)
    want, spread = np.polyfit(x, y, 2, w=w, cov=True)
    assert np.allclose(got, want) and np.allclose(error, np.sqrt(np.diag(spread)))


def test_scan_is_that_of_each_term():
    mag, bp, rp = stars(300, 0.7)
    order = np.argsort(mag)
    mag, bp, rp = mag[order], bp[order], rp[order]
    err = np.random.default_rng(1).uniform(0.5, 2, 300)
    terms = np.array([-2.0, 0.0, 0.7, 3.0])
    got = ph.scan(mag, rp, bp - rp, np.zeros(300), err, terms, 0.3)
    for c, stat in zip(terms, got, strict=True):
        nat = rp + c * (bp - rp)
        off = nat - lowess(mag, nat, 0.3, 0, 0.2)
        assert abs(stat - np.sqrt(((off / err) ** 2).mean()) * np.sqrt((err**2).mean())) < 1e-9


@pytest.mark.parametrize("term", [-0.8, 0.4, 1.9])
def test_colour_term_is_found(term):
    mag, bp, rp = stars(900, term)
    mag[::50] += 3  # outliers
    got = ph.colour_term(mag, bp, rp)
    assert abs(got["color_term"] - term) < 0.03 and got["cterm_iterations"] == 3 and 0 < got["color_term_error"] < 0.2
    assert 700 > got["cterm_num_stars"] > 100 or got["cterm_num_stars"] > 500
    assert ph.colour_term(mag[:8], bp[:8], rp[:8]) is None


def test_local_outliers_and_bins():
    rng = np.random.default_rng(4)
    mag, residual = np.sort(rng.uniform(8, 14, 400)), rng.normal(0, 0.1, 400)
    residual[::40] = 2.0
    out = ph.local_outliers(mag, residual, 8, 14, mean=True)
    assert out[::40].all() and out.sum() < 30
    assert not ph.local_outliers(mag, residual, 8, 14).any()  # a sum of many squares exceeds each of them
    bins = ph.magnitude_bins(mag)
    assert bins[0][0] == mag[0] and bins[-1][1] == mag[-1] and all(a[1] == b[0] for a, b in zip(bins, bins[1:], strict=False))
    for low, high in bins:
        n = ((mag >= low) & (mag <= high)).sum()
        assert n >= 100 and (high - low >= 0.5 or n <= 101)


def test_surfaces():
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 9000, 800), rng.uniform(0, 7000, 800)
    z = 0.1 + 2e-5 * x - 3e-9 * x * y + 1e-13 * x**2 * y
    assert np.allclose(ph.surface_of(x, y, z)(x, y), z, atol=1e-9) and ph.surface_of(x[:80], y[:80], z[:80]).degree == 3 and ph.surface_of(x[:50], y[:50], z[:50]) is None
    mag = rng.uniform(8, 14, 800)
    tilt = z + 1e-5 * (mag - 11) * (x - 4500)
    fixed = ph.Correction(x, y, mag, tilt)
    assert (tilt - fixed(x, y, mag)).std() < 0.3 * (tilt - fixed.whole(x, y)).std()


def test_whole_calibration(spark):
    mag, bp, rp = stars(900, 0.6)
    rng = np.random.default_rng(6)
    x, y = rng.uniform(0, 9000, 900), rng.uniform(0, 7000, 900)
    rows = [(int(k), "p", *map(float, v)) for k, v in enumerate(zip(mag, bp, rp, x, y, strict=True))] + [(5000 + k, "few", 1.0 * k, 2.0, 1.0, 0.0, 0.0) for k in range(5)]
    frame = spark.createDataFrame(rows, "id long, plate string, mag double, bp double, rp double, x double, y double")
    (got,) = ph.calibrated_solutions(frame, ["plate"]).collect()
    assert got.plate == "p" and abs(got.color_term - 0.6) < 0.03 and 0.01 < got.rmse_median < 0.08
    # The curve against the truth: natural magnitudes that give the plate magnitudes
    nat = np.linspace(6, 20, 2000)
    truth = np.interp(got.curve_mag, (nat - 20) * 0.8 + 0.02 * (nat - 12) ** 2, nat)
    assert np.abs(np.array(got.curve_natmag) - truth)[3:-3].max() < 0.08
    terms = {r.plate: r.color_term for r in ph.colour_terms(frame, ["plate"]).collect()}
    assert terms == {"p": got.color_term}


def test_depth_against_a_plain_loop(spark):
    truth = {k: (11.0 + k % 5, 11.5 + (k * 7) % 9, (k % 4) * 0.3) for k in range(20)}

    def answer(k, high):
        """Faint limit and estimate with a catalogue to `high`; some plates can't be calibrated beyond 14."""
        if k % 6 == 5 and high > 14:
            return None
        return min(high - 0.2, truth[k][0] + 3), min(truth[k][1], high + 1.5)

    def plain(k):
        faint, estimate, term = truth[k]
        most, limit, rounds, low = 19 + term, 0.0, 0, 0.0
        high = min(estimate + 1 if estimate < faint + 2 else (faint + estimate) / 2 + 1, 15.0)
        while limit < faint + 0.7 and limit < most and high > limit:
            got, limit, rounds = answer(k, high), high, rounds + 1
            if got is None:
                break
            faint, estimate = got
            deeper = estimate + 1 if estimate < faint + 2 else min((faint + min(estimate, most)) / 2 + 1, limit + 2)
            if deeper <= limit:
                break
            high = min(deeper, most)
        return round(limit, 9), rounds

    def calibrate(open_):
        rows = [(r.plate, *a) for r in open_.collect() if (a := answer(r.plate, r.high)) is not None]
        return spark.createDataFrame(rows, "plate long, faint_limit double, estimate double").withColumn("color_term", F.lit(0.0))

    first = spark.createDataFrame([(k, float(a), float(b), float(c)) for k, (a, b, c) in truth.items()], "plate long, faint_limit double, estimate double, color_term double")
    got = {r.plate: (round(r.limit, 9), r.rounds) for r in ph.adaptive_depth(first, calibrate, "plate").collect()}
    assert got == {k: plain(k) for k in truth} and max(n for _, n in got.values()) > 1


def tilted(n=1500, seed=9):
    rng = np.random.default_rng(seed + 100)
    mag, bp, rp = stars(n, 0.6, seed)
    x, y = rng.uniform(0, 9000, n), rng.uniform(0, 7000, n)
    tilt = (x - 4500) * 6e-5 + (y - 3500) * (rp - 12) * 2e-5
    return mag - tilt, bp, rp, x, y, tilt


def test_correction_by_columns_is_that_of_the_kernel(spark):
    mag, bp, rp, x, y, _ = tilted()
    found = ph.corrected_solution(mag, bp, rp, x, y)
    assert found["iterations"] == 2 and found["surface"]["degree"] == 5 and len(found["bin_mags"]) > 3
    names = "id long, plate string, mag double, bp double, rp double, x double, y double, bp_rp double"
    rows = [(k, "p", *map(float, v), float(v[1] - v[2])) for k, v in enumerate(zip(mag, bp, rp, x, y))]
    frame = spark.createDataFrame(rows, names)
    solutions = ph.corrected_solutions(frame, ["plate"])
    # Beyond the stars, at the bins' edges, without a magnitude, and on plates without a solution.
    more = [(9000, "p", -30.0, None, None, -50.0, 9000.0, None), (9001, "p", 30.0, None, None, 4000.0, -9.0, 0.5), (9002, "p", 99.0, None, None, 1.0, 1.0, 1.0), (9003, "q", 10.0, None, None, 1.0, 1.0, 1.0), (9004, None, 10.0, None, None, 1.0, 1.0, 1.0)]
    got = {r.id: r for r in ph.corrected_magnitudes(frame.unionByName(spark.createDataFrame(more, names)), solutions, ["plate"]).collect()}
    assert len(got) == len(rows) + len(more)
    _, fixed, error = ph._calibrated(mag, bp, rp, x, y, 0.1, *_first_round(mag, bp, rp, x, y))
    want = fixed(np.append(x, [-50.0, 4000.0]), np.append(y, [9000.0, -9.0]), np.append(mag, [-30.0, 30.0]))
    assert np.allclose([got[k].natmag_correction for k in (*range(len(mag)), 9000, 9001)], want, atol=1e-9)
    assert np.allclose([got[k].natmag_plate for k in range(0, 1500, 50)], np.interp(mag[::50], found["curve_mag"], found["curve_natmag"]), atol=0.02)
    assert got[9000].phot_range_flag == 1 and got[9001].phot_range_flag == 2 and got[9000].rpmag is None
    assert abs(got[9001].rpmag - (got[9001].natmag - found["color_term"] * 0.5)) < 1e-9 and abs(got[9001].bpmag - got[9001].rpmag - 0.5) < 1e-9
    assert abs(got[9001].rpmag_error - np.hypot(got[9001].natmag_error, found["color_term_error"] * 0.5)) < 1e-9
    assert all(got[k].natmag is None and got[k].phot_range_flag == 0 for k in (9002, 9003, 9004))


def _first_round(mag, bp, rp, x, y):
    order = np.argsort(mag, kind="stable")
    _, fixed, error = ph._calibrated(*(v[order] for v in (mag, bp, rp, x, y)), 0.1)
    return fixed(x, y, mag), error(mag)


def test_tilt_is_gone_and_the_second_term_is_nearer():
    mag, bp, rp, x, y, tilt = tilted(2500)
    one, two = (ph.corrected_solution(mag, bp, rp, x, y, rounds=k) for k in (1, 2))
    assert abs(two["color_term"] - 0.6) <= abs(one["color_term"] - 0.6) + 0.005 and two["rmse_median"] < 0.1 < tilt.std()
    few = ph.corrected_solution(mag[:40], bp[:40], rp[:40], x[:40], y[:40])
    assert few is None or few["surface"] is None and few["bin_mags"] == []


def test_ends_of_the_curve_are_freed_of_the_slope_over_the_plate(spark, monkeypatch):
    """Plates whose brightest stars, beyond the curve's limit, were off by up to a magnitude where few stars held its end."""
    from skyledger.plans import exposure_queries

    load = exposure_queries.load
    monkeypatch.setattr(exposure_queries, "load", lambda *a: load(*a).where("l_suppkey IN (436, 521, 839, 867)"))
    rows = exposure_queries.corrected_magnitudes(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 4 and all(r.mostly_near and r.flat and r.was_tilted and r.term_near for r in rows)
