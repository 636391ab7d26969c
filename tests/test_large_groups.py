import tracemalloc

import numpy as np
from skyledger.operators import fits, photometry


def test_scan_holds_no_copy_of_the_stars_for_each_term():
    rng, n = np.random.default_rng(3), 40_000
    mag = np.sort(rng.uniform(8, 16, n))
    rp, colour = mag + rng.normal(0, 0.1, n), rng.uniform(0, 2, n)
    zero, one = np.zeros(n), rng.uniform(0.5, 2, n)
    tracemalloc.start()
    got = photometry.scan(mag, rp, colour, zero, one, photometry.COARSE, 0.2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    base, slope = (v - fits.lowess(mag, v, 0.2, 0, 0.2) for v in (rp, colour))
    want = [np.sqrt((((base + t * slope) / one) ** 2).mean() * (one**2).mean()) for t in photometry.COARSE]
    assert np.allclose(got, want, rtol=1e-12) and peak < 15 * 8 * n


def test_surfaces_by_parts(monkeypatch):
    rng = np.random.default_rng(4)
    x, y, mag, z = rng.uniform(0, 1e4, 3000), rng.uniform(0, 8e3, 3000), rng.uniform(8, 16, 3000), rng.normal(0, 1, 3000)
    whole = photometry.Correction(x, y, mag, z)(x, y, mag)
    monkeypatch.setattr(photometry, "PART", 70)
    assert np.allclose(photometry.Correction(x, y, mag, z)(x, y, mag), whole, atol=1e-9)


def test_colour_terms_take_one_star_of_each_magnitude(spark):
    rng, n = np.random.default_rng(5), 6000
    bp = rng.integers(0, 300, n) / 25 + 8
    rp, mag = bp - rng.integers(0, 50, n) / 50, rng.integers(0, 4000, n) / 400 + 5
    rows = [(1, k, float(m), float(b), float(r)) for k, (m, b, r) in enumerate(zip(mag, bp, rp))] + [(1, n, None, 1.0, 1.0), (1, n + 1, 3.0, float("nan"), 1.0), (2, n + 2, 3.0, None, 1.0)]
    stars = spark.createDataFrame(rows, "plate int, id long, mag double, bp double, rp double")
    order = np.argsort(mag, kind="stable")
    want = photometry.colour_term(mag[order], bp[order], rp[order])
    seen, old = [], photometry._grouped
    photometry._grouped = lambda rows, *a: seen.append(rows.count()) or old(rows, *a)
    try:
        got = [r.asDict() for r in photometry.colour_terms(stars, ["plate"]).collect()]
    finally:
        photometry._grouped = old
    assert seen == [len(np.unique(bp))]
    assert (want is None and not got) or all(np.isclose(got[0][c], v, equal_nan=True) for c, v in want.items())


def test_lowess_takes_no_step_for_each_point():
    """Many points between two places of the curve cost no line of Python each."""
    import sys

    x = np.sort(np.random.default_rng(6).uniform(0, 1, 20_000))
    lines = [0]

    def count(frame, event, arg):
        if frame.f_code is not fits.lowess.__code__:
            return None
        lines[0] += 1
        return count

    sys.settrace(count)
    try:
        fits.lowess(x, x * 2, 0.2, 0, 0.1)
    finally:
        sys.settrace(None)
    assert lines[0] < 3000
