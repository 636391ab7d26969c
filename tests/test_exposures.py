import numpy as np
from pyspark.sql import functions as F
from skyledger.operators import crossmatch, exposures, fits

SOURCES, PLATES = "plate long, id long, x double, y double, mag double", "plate long, numexp int, dist_peak double, width int, height int"


def pattern(rng, plate, offsets, stars, angle=lambda x, y: 0.0, noise=0.2, lost=()):
    """(rows, {id: exposure}) of stars on a lattice, each with an image at every offset."""
    rows, truth = [], {}
    for n in range(stars):
        x0, y0 = 900 + n % 8 * 1000 + rng.uniform(0, 150), 900 + n // 8 * 1000 + rng.uniform(0, 150)
        t = np.radians(angle(x0, y0))
        mag = rng.uniform(8, 14)
        for e, (dx, dy) in enumerate(offsets):
            if (n, e) in lost:
                continue
            key = plate * 100_000 + n * 100 + e
            rows.append((plate, key, float(x0 + dx * np.cos(t) - dy * np.sin(t) + rng.normal(0, noise)), float(y0 + dx * np.sin(t) + dy * np.cos(t) + rng.normal(0, noise)), float(mag + rng.normal(0, 0.02))))
            truth[key] = 0 if any(m == n for m, _ in lost) else e + 1
    return rows, truth


def labels(spark, rows, plates):
    df = exposures.exposure_numbers(spark.createDataFrame(rows, SOURCES), spark.createDataFrame(plates, PLATES))
    return {r.id: r.exposure_num for r in df.collect()}


def test_planted_patterns(spark):
    rng = np.random.default_rng(11)
    along = [(0, 0), (45, 5), (95, -4), (150, 6), (190, 0)]
    upright = [(0, 0), (3, 50), (-4, 92), (6, 150), (2, 200), (0, 260)]
    one, truth = pattern(rng, 1, along, 40, lambda x, y: (x - 5000) * 1e-3 + (y - 4000) * 5e-4, lost={(5, 2), (17, 0)})
    two, more = pattern(rng, 2, upright, 24)
    few, none = pattern(rng, 3, along, 4)
    lone = [(1, 1_000_000 + k, float(rng.uniform(0, 10000)), float(7400 + rng.uniform(0, 500)), 12.0) for k in range(60)] + [(1, 2_000_000, None, 5.0, 9.0), (1, 2_000_001, 5.0, 5.0, None), (4, 2_000_002, 5.0, 5.0, 9.0), (None, 2_000_003, 5.0, 5.0, 9.0)]
    plates = [(1, 5, 45.0, 10000, 8000), (2, 6, 45.0, 10000, 8000), (3, 5, 45.0, 10000, 8000), (9, 5, 45.0, 10000, 8000)]
    want = truth | more | {k: 0 for k in none} | {r[1]: 0 for r in lone}
    got = labels(spark, one + two + few + lone, plates)
    assert got == want and {0, 1, 5, 6} <= set(got.values())
    assert labels(spark, [], plates) == {}


def test_place_of_the_faintest_pattern_counts(spark):
    # Two stars whose patterns share a detection: that of the fainter first image gives its number.
    rows = [(1, k * 10 + e, 500.0 * k + 100.0 * e, 100.0, 10.0 + k) for k in range(12) for e in (0, 1)] + [(1, 900, 400.0 + 500.0, 100.0, 16.0)]
    pattern = spark.createDataFrame([(1, 1, 0.0, 0.0, 2), (1, 2, 100.0, 0.0, 2)], "plate long, exposure_num int, dx double, dy double, num_exposures int")
    flat = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0)], "plate long, " + ", ".join(f"{c} double" for c in exposures.PLANES))
    got = {r.id: r.exposure_num for r in exposures.labelled(spark.createDataFrame(rows, SOURCES), pattern, flat).collect()}
    assert got[900] == 1 and got[20] == 2 and got[21] == 2 and got[0] == 1 and got[1] == 2


def test_clusters_in_three_dimensions(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, (3, 3, 0.3), (40, 3)) for c in ((0, 0, 0), (12, 0, 0), (0, 40, 5), (0, 0, 3))] + [rng.uniform(-60, 60, (60, 3)) * (1, 1, 0.1)])
    group = np.arange(len(points)) % 2
    widths, least = {"x": 5.0, "y": 5.0, "z": 0.5}, 4
    df = spark.createDataFrame([(k, int(g), *map(float, p)) for k, (p, g) in enumerate(zip(points, group))], "id long, g int, x double, y double, z double")
    for crowded in (10_000, 7):
        old, crossmatch.CROWDED = crossmatch.CROWDED, crowded
        try:
            got = {r.id: r.label for r in fits.dbscan_in(df, "id", widths, least, ("g",)).collect()}
        finally:
            crossmatch.CROWDED = old
        scaled = points / (5.0, 5.0, 0.5)
        near = (np.linalg.norm(scaled[:, None] - scaled[None], axis=2) <= 1) & (group[:, None] == group[None])
        core, label = near.sum(1) >= least, {}
        for k in range(len(points)):
            if core[k] and k not in label:
                todo = [k]
                while todo:
                    if (i := todo.pop()) not in label:
                        label[i] = k
                        todo += [j for j in np.flatnonzero(near[i] & core).tolist() if j not in label]
        want = {k: label.get(k, min((label[j] for j in np.flatnonzero(near[k] & core).tolist()), default=None)) for k in range(len(points))}
        assert got == want and len(set(want.values())) > 3


def test_planes_are_found(spark):
    rng = np.random.default_rng(8)
    rows, _ = pattern(rng, 1, [(0, 0), (60, 8), (110, 0), (170, 12), (240, -9)], 48, lambda x, y: 2 + (x - 5000) * 1e-3, noise=0.05)
    members = exposures.regular_clusters(exposures.star_clusters(spark.createDataFrame(rows, SOURCES), spark.createDataFrame([(1, 5, 50.0, 9000, 7000)], PLATES)))
    r = exposures.planes(fits.checkpointed(members)).withColumn("tilt", F.col("angle_x")).first()
    assert abs(r.tilt - 1e-3) < 5e-5 and abs(r.angle_y) < 5e-5 and abs(r.scale_0 - 1) < 5e-3


def test_plates_are_clustered_without_pairs(spark, monkeypatch):
    # Neighbours of a place grow with the square of its members: no pair of them is shuffled or stored.
    def none(*_):
        raise AssertionError("pairs of neighbours were formed")

    rng = np.random.default_rng(5)
    rows, _ = pattern(rng, 1, [(0, 0), (45, 5), (95, -4), (150, 6)], 32)
    monkeypatch.setattr(exposures, "grid_pairs", none)
    monkeypatch.setattr(fits, "density_labels", none)
    members = exposures.regular_clusters(exposures.star_clusters(spark.createDataFrame(rows, SOURCES), spark.createDataFrame([(1, 4, 45.0, 10000, 8000)], PLATES)))
    assert exposures.exposure_places(members, exposures.planes(members)).count() == 4


def test_clusters_of_each_group_are_those_of_the_join(spark):
    rng = np.random.default_rng(6)
    at = np.concatenate([rng.normal(c, 3, (60, 2)) for c in ((0, 0), (13, 2), (-5, 30))] + [rng.uniform(-60, 60, (700, 2))])
    rows = [(int(k) * 7 % 1009, k % 2 if k % 50 else None, float(x), float(y), 3 + k % 3) for k, (x, y) in enumerate(at)] + [(5000, 0, float("nan"), 1.0, 1), (5001, 0, None, 1.0, 1), (5002, 1, 500.0, 500.0, 1)]
    df = spark.createDataFrame(rows, "id long, g int, x double, y double, least int")
    want = {r.id: r.label for r in fits.dbscan_in(df, "id", {"x": 2.5, "y": 4.0}, "least", ("g",)).where("label IS NOT NULL").collect()}
    got = {r.id: r.label for r in fits.clusters_each(df, "g", "id", {"x": 2.5, "y": 4.0}, "least").collect()}
    assert got == want and len(got) > 100 and got[5002] == 5002
