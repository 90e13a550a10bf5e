import hashlib
import random

import numpy as np

from sentiflow.llm import centroids as C


def brute(rows, k=16, rounds=3, dims=64):
    """{row number: (vec_id, cluster, distance, cluster inertia, inertia, centroid hash)} by measuring everything in Python integers."""
    kept = {}
    for r, (vec_id, v) in enumerate(rows):
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept[r] = (vec_id, [int(np.floor(64 * float(x))) for x in v], v)

    def seed(r):
        vec_id, _, v = kept[r]
        return vec_id is None, hashlib.sha256(f"1:{vec_id}".encode()).hexdigest() if vec_id is not None else "", v

    cents = [list(kept[r][1]) for r in sorted(kept, key=seed)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        of = {r: nearest(kept[r][1])[1] for r in kept}
        for j in range(len(cents)):
            mine = [kept[r][1] for r in kept if of[r] == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = {r: nearest(kept[r][1]) for r in kept}
    own = {j: sum(d for d, i in last.values() if i == j) for j in range(len(cents))}
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(kept[r][0]), j, d, own[j], sum(own.values()), named[j]) for r, (d, j) in last.items())


def results(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, 7, "x", "y", 3) for i, v in rows], "vec_id long, embedding array<double>, cluster int, vec string, bounds string, n int")
    return sorted((str(r[0]), *r[1:]) for r in C.cluster(frame, **more).collect())


def vectors(seed, n, dims=64, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 2, (6, dims))
    return [(i, (centre[i % 6] + rng.normal(0, spread, dims)).tolist()) for i in range(n)]


def test_odd_vectors_repeats_and_ties(spark):
    rows = vectors(1, 150)
    rows += [rows[3]] * 20 + [(4, rows[9][1])] * 5 + [(None, rows[10][1]), (None, rows[11][1])]
    rows += [(200 + i, [float(i % 2)] * 64) for i in range(20)]  # ties
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63)]
    rows += [(305, [float("nan")] * 64), (306, [float("inf")] + [0.0] * 63), (307, [-1e-9] * 64), (308, [2.0**20] + [0.0] * 63)]
    assert results(spark, rows) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(2, 5)
    assert results(spark, rows) == brute(rows)
    assert results(spark, []) == []
    assert results(spark, [(1, None)]) == []
    assert results(spark, rows, rounds=0) == brute(rows, rounds=0)
    assert results(spark, rows, k=2, rounds=6) == brute(rows, k=2, rounds=6)


def test_components_that_no_long_distance_holds(spark):
    rows = vectors(3, 40)
    wide = [(900, [1e300] + [0.0] * 63), (901, [-(2.0**21) - 1] * 64)]
    got = results(spark, rows + wide)
    assert [r for r in got if r[0] in ("900", "901")] == [(i, None, None, None, None, None) for i in ("900", "901")]
    assert [r for r in got if r[0] not in ("900", "901")] == brute(rows)
    assert results(spark, wide) == [(i, None, None, None, None, None) for i in ("900", "901")]


def test_bounds_stay_exact_and_save_work():
    rng = np.random.default_rng(5)
    x = np.floor(64 * (rng.normal(0, 3, (8, 16))[rng.integers(0, 8, 3000)] + rng.normal(0, 0.5, (3000, 16)))).astype(np.int64)
    x[:50] = x[0]
    rounds = [x[rng.choice(3000, 10, replace=False)].copy()]
    b = C.measured(x, C.History(rounds))
    counted = []
    for _ in range(12):
        cents = [x[b.cluster == j].sum(axis=0) // max(1, (b.cluster == j).sum()) if (b.cluster == j).any() else rounds[-1][j] for j in range(10)]
        rounds.append(np.array(cents))
        packed = np.frombuffer(b"".join(b.pack()), np.uint8).reshape(len(x), -1)
        b = C.Bounds.unpack(b.cluster, packed, 10)
        counted.append(C.reassigned(x, b, C.History(rounds)))
        d2 = ((x[:, None, :] - rounds[-1][None]) ** 2).sum(axis=2)
        assert (b.cluster == d2.argmin(axis=1)).all()
    assert counted[-1] < 0.1 * d2.size


def test_loosened_by_total_displacement():
    """A centroid that comes back to where it was loosens nothing, however far it went."""
    x = np.array([[0, 0], [100, 0]])
    first, away = np.array([[0, 0], [90, 0]]), np.array([[0, 0], [1000, 0]])
    b = C.measured(x[:1], C.History([first]))
    assert C.reassigned(x[:1], b, C.History([first, away, first])) == 0


def test_empty_cluster_keeps_its_centroid(spark):
    rows = [(i, [0.0] * 64) for i in range(20)]
    assert results(spark, rows, k=4) == brute(rows, k=4)
    random.Random(1).shuffle(rows)
    assert results(spark, rows, k=4) == brute(rows, k=4)
