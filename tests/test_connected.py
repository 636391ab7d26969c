"""Density clusters of long shapes: rounds go with the logarithm of their width."""

import numpy as np
import pytest
from skyledger.operators import fits


def ring(n):
    """A spiral of n places about one apart, by ids without an order."""
    turn = np.sqrt(np.arange(1, n + 1) * 4)
    return np.stack((turn * np.cos(turn), turn * np.sin(turn)), 1), np.random.default_rng(7).permutation(n)


@pytest.mark.parametrize("apart", [False, True])
def test_clusters_of_a_spiral_take_few_rounds(spark, monkeypatch, apart):
    at, ids = ring(1500)
    if apart:
        at[700:740] += 1e6
    rows = [(int(k), float(x), float(y)) for k, (x, y) in zip(ids, at)] + [(5000, None, 1.0), (5001, float("nan"), 1.0), (5002, -9e5, 3.0)]
    points, made, old = spark.createDataFrame(rows, "id long, x double, y double"), [], fits.checkpointed
    monkeypatch.setattr(fits, "checkpointed", lambda df: made.append(1) or old(df))
    got = {r.id: r.label for r in fits.dbscan_labels(points, "id", 2.2, 3).collect()}
    label = fits._dense(at / 2.2, ids.astype(np.int64), np.full(len(at), 3))
    assert got == {int(k): None if v < 0 else int(v) for k, v in zip(ids, label)} | {5000: None, 5001: None, 5002: None}
    assert len(set(label)) < 6 and len(made) <= (24 if apart else 14)


def test_no_core_point(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 0.0)], "id long, x double, y double")
    assert [r.label for r in fits.dbscan_labels(points, "id", 1.0, 2).collect()] == [None, None]
