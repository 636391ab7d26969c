import numpy as np
import pytest
from skyledger import plans
from skyledger.operators import crossmatch, fits

#: Few places with many points each, as in copies of a table, two of them crowded.
RNG = np.random.default_rng(8)
PLACES = RNG.uniform(0, 400, (30, 2)).round(1)
AT = np.concatenate([RNG.integers(0, 30, 150), np.full(40, 3), np.full(20, 7)])
XY = PLACES[AT]
DIST = np.hypot(*(XY[:, None] - XY[None]).transpose(2, 0, 1))
N = len(XY)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(k, *map(float, p)) for k, p in enumerate(XY)] + [(900, None, 1.0), (901, float("nan"), 1.0), (902, float("inf"), 1.0)]
    return spark.createDataFrame(rows, "id long, x double, y double")


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_others_of_crowded_places(points, k):
    want = {(i, n + 1): (j, round(d, 6)) for i in range(N) for n, (d, j) in enumerate(sorted((float(DIST[i, j]), j) for j in range(N) if j != i and DIST[i, j] < 60)[:k])}
    rows = crossmatch.nearest_others(points, 60.0, "id", k).collect()
    assert {(r.left_id, r.nth): (r.right_id, round(r.dist, 6)) for r in rows} == want and len(rows) == len(want)


def test_matches_counts_and_flags_of_crowded_places(points):
    refs = points.where("id % 3 = 0 OR id >= 900")
    own = [k for k in range(N) if k % 3 == 0]
    near = {i: sorted((float(DIST[i, j]), j) for j in own if DIST[i, j] < 25) for i in range(N)}
    got = {r.left_id: (round(r.dist, 6), r.right_id) for r in crossmatch.nearest_match(points, refs, 25.0, "id", "id").collect()}
    assert got == {i: (round(v[0][0], 6), v[0][1]) for i, v in near.items() if v}
    counts = {r.left_id: r.neighbours for r in crossmatch.neighbour_counts(points, refs, 25.0, "id", "id").collect()}
    assert counts == {i: len(v) for i, v in near.items()} | {900: 0, 901: 0, 902: 0}
    flagged = crossmatch.flagged_pairs(points, refs, 25.0, 10.0, "id", "id").collect()
    assert sorted((r.left_id, r.right_id, r.flag_xmatch) for r in flagged) == sorted((i, j, int((d, j) == v[0] and d < 10)) for i, v in near.items() for d, j in v)
    assert {r.id for r in crossmatch.unmatched(points, refs, 25.0, "id", "id").collect()} == {i for i in range(N) if not (DIST[i, own] <= 25).any()} | {900, 901, 902}
    assert {r.id for r in crossmatch.isolated(points, 25.0, "id").collect()} == {i for i in range(N) if (DIST[i] <= 25).sum() == 1} | {900, 901, 902}


def test_density_clusters_of_crowded_places(points, spark, tmp_path):
    """Counts are those of points, clusters those of all points; the pairs that are kept are those of places."""
    near, least = DIST <= 45, 12
    core, label = near.sum(1) >= least, {}
    for k in range(N):
        todo = [k] if core[k] and k not in label else []
        while todo:
            if (i := todo.pop()) not in label:
                label[i] = k
                todo += [j for j in np.flatnonzero(near[i] & core).tolist() if j not in label]
    want = {k: label.get(k, min((label[j] for j in np.flatnonzero(near[k] & core).tolist()), default=None)) for k in range(N)} | {900: None, 901: None, 902: None}
    seen = []
    old, fits.density_labels = fits.density_labels, lambda p, pairs, *a: seen.append(pairs.count()) or old(p, pairs, *a)
    try:
        assert {r.id: r.label for r in fits.dbscan_labels(points, "id", 45.0, least).collect()} == want
    finally:
        fits.density_labels = old
    assert seen[0] <= 30 * 30 and len(set(want.values())) > 2


def joins(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("name", ["all_neighbours", "flag_xmatch", "isolated_points", "neighbour_counts", "nearest_match_tol", "nn_self_plane", "nn_self_plane_all", "pattern_search", "psf_overwrite", "two_nn_angle", "two_nn_angle_all", "spatial_anti", "sky_neighbours"])
def test_no_neighbourhood_is_broadcast(spark, name):
    """Only the list of crowded cells is broadcast, which holds a row for each CROWDED rows; the rows of neighbourhoods are shuffled."""
    df = plans.QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = joins(df)
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")] if "Final Plan" in plan else plan
    assert "BroadcastHashJoin" not in final and "BroadcastNestedLoopJoin" not in final
