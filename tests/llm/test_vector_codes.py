import hashlib
import math
from collections import defaultdict

import numpy as np
from skyledger.llm import vector_codes
from tests.oracle import SF

COLUMNS = "vec_id long, embedding array<double>, label int, code string"


def by_hand(rows, entries=256, rounds=4):
    """The contract in plain Python: rows of (vec_id, components or None, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    each = -(-max((len(r[1]) for r in kept), default=0) // 4)
    whole = [[math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024 for x in r[1]] for r in kept]
    cut = [[tuple((v + [0] * (4 * each))[p * each : (p + 1) * each]) for p in range(4)] for v in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(4)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def near(p, v):
        return min(range(len(books[p])), key=lambda e: (far(v, books[p][e]), e))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for v in cut:
                members[near(p, v[p])].append(v[p])
            for e, m in members.items():
                books[p][e] = tuple(sum(x) // len(m) for x in zip(*m))
    out, total = [], defaultdict(int)
    for r, v in zip(kept, cut):
        own = [near(p, v[p]) for p in range(4)]
        error = sum(far(v[p], books[p][own[p]]) for p in range(4))
        total[r[2]] += error
        out.append((r[0], "".join(f"{e:02x}" for e in own), error, r[2]))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return sorted(((i, c, min(e, most), min(total[k], most), digest) for i, c, e, k in out), key=str)


def got(df, **how):
    codes = vector_codes.fit_codes(df, **how)
    rows = vector_codes.with_label_error(codes.rows)
    return sorted(((r.id, r.code, r.error, r.label_error, codes.digest()) for r in rows.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], COLUMNS)


def test_given_table(spark):
    rows = sorted(map(tuple, vector_codes.op11_vector_codes(spark, SF).collect()), key=str)
    vectors = [(r.vec_id, list(map(float, r.embedding)) if r.embedding is not None else None, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows == by_hand(vectors)


def test_ties_copies_and_small_codebooks(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), [float(x) / 512 for x in r.integers(-3, 4, 8)], [None, 1, 2][i % 3]) for i in r.permutation(700)]
    rows += rows[:5] + [(1000 + k, rows[0][1], 1) for k in range(200)]
    for entries in (1, 3, 40):
        assert got(table(spark, rows).repartition(3), entries=entries, block_values=600) == by_hand(rows, entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 2.0, 3.0], 1), (3, [nan] * 4, 1), (4, [inf, 0.0, 0.0, 0.0], 2), (5, [0.5, -0.0001, 2.0], 2), (None, [0.25, 1.0, 2.0, 3.0, 9.0], None), (6, [], None), (6, [0.1], 7), (6, [0.1], 7)]
    assert got(table(spark, rows)) == by_hand(rows)
    assert got(table(spark, rows).limit(0)) == [] == by_hand([])
    assert got(table(spark, rows[:4])) == []
    assert {r[1] for r in got(table(spark, [(1, [], 1), (2, [], None)]))} == {"00000000"}


def test_components_beyond_exact_doubles(spark):
    rows = [(k, [float(k * 10**6), -1e15 * k, 0.1, 2.0**60], k % 2) for k in range(12)]
    assert got(table(spark, rows), entries=5) == by_hand(rows, 5)
    rows += [(20, [1.5e308, 0.0, 0.0, 1e-300], 0)]
    assert got(table(spark, rows), entries=5) == by_hand(rows, 5)


def test_heaps_leave_settled_parts_alone(spark, monkeypatch):
    seen = []
    r = np.random.default_rng(5)
    x = np.concatenate([c + r.normal(0, 2, (60, 4)) for c in r.normal(0, 900, (8, 4))]).round()
    books = vector_codes.Books(np.stack([x[::60].astype(np.int64)]), np.zeros((1, 8)), True)
    row = {"n": len(x)}
    own, heaps, _ = vector_codes._assigned(row, x[None], books)
    row |= {"own": own.astype(np.uint16).tobytes(), "heap": np.array([i for h in heaps[0] for _, i in h], "<i4").tobytes(), "slack": np.array([s for h in heaps[0] for s, _ in h]).tobytes(), "ends": np.cumsum([len(h) for h in heaps[0]]).astype("<i4").tobytes()}
    nearest = vector_codes._nearest
    monkeypatch.setattr(vector_codes, "_nearest", lambda v, *a: seen.append(len(v)) or nearest(v, *a))
    moved = vector_codes.Books(books.entries + 1, np.full((1, 8), 4.1), True)
    again, _, _ = vector_codes._assigned(row, x[None], moved)
    assert seen[0] < 20 and (again[0] == nearest(x, moved.entries[0], True)[0]).all()


def test_labels_too_many_to_send(spark, monkeypatch):
    coded = spark.createDataFrame([(k, None if k % 5 == 0 else k % 7, k) for k in range(60)], "id long, label int, error long")
    want = {tuple(r) for r in vector_codes.with_label_error(coded).select("id", "label_error").collect()}
    for most, hot in ((0, 10**9), (2, 9)):
        monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", most)
        monkeypatch.setattr(vector_codes, "HOT_ROWS", hot)
        rows = vector_codes.with_label_error(coded).select("id", "label_error").collect()
        assert len(rows) == 60 and {tuple(r) for r in rows} == want
