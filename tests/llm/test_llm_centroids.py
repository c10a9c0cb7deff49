"""Centroid clustering against plain loops over Python integers."""

import hashlib
import math

import numpy as np
import pytest

from ledgerlens.llm import centroids
from test_llm_operators import same

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v int"


def brute(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in map(float, v)]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        cs = [[sum(x) // len(x) for x in zip(*[v for (_, v), a in zip(kept, at) if a == n])] if n in at else c for n, c in enumerate(cs)]
    last = [(i, *nearest(v)) for i, v in kept]
    own = {n: sum(d for _, d, m in last if m == n) for n in range(len(cs))}
    return [(i, n, d, own[n], sum(own.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, d, n in last]


def vectors(rng, n):
    middles = rng.normal(0, 0.4, (6, 64))
    return [np.float32(middles[i % 6] + rng.normal(0, 0.1, 64)).tolist() for i in range(n)]


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA).repartition(parts)
    return [tuple(r) for r in centroids.op12_centroid_clustering(df).collect()]


def test_query(spark):
    rng = np.random.default_rng(2)
    made = list(enumerate(vectors(rng, 300)))
    hot = made[5][1]
    bad = [(900, None), (901, []), (902, hot[:63]), (903, hot + [0.0]), (904, [None] + hot[1:]), (905, [float("nan")] + hot[1:]),
           (906, [float("inf")] + hot[1:]), (907, [float("-inf")] * 64)]
    rows = made + [(1000 + i, hot) for i in range(150)] + [made[7]] * 3 + [(None, made[9][1]), (None, made[10][1])] + bad
    same(run(spark, rows), brute(rows))


@pytest.mark.parametrize("rows", [
    [],
    [(1, [0.25] * 64)],
    [(i, [0.5] * 64) for i in range(20)],                        # all equal: every distance ties
    [(i, [float(i % 3)] * 64) for i in range(40)],               # pivots on one line, equal centroids
    [(i, [(-1.0) ** i * 100000 / 2 ** j for j in range(64)]) for i in range(12)],
], ids=["empty", "one", "equal", "line", "large"])
def test_edges(spark, rows):
    same(run(spark, rows), brute(rows))


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="134217728 or more"):
        run(spark, [(1, [1e30] * 64)])


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(7)
    data = np.floor(1024 * np.array(vectors(rng, 400))).astype(np.int64)
    simplex = centroids.Simplex(data[:16])
    mean = np.stack([data[i::6].sum(0) // len(data[i::6]) for i in range(6)])
    can = simplex.candidates(simplex.apexes(data), simplex.apexes(mean))
    exact = ((data[:, None] - mean[None]) ** 2).sum(2)
    assert can[np.arange(len(data)), exact.argmin(1)].all()
    assert can.mean() < 0.5  # most centroids are not compared
    number, distance = centroids.nearest(simplex, data, simplex.apexes(data), mean)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    close = rng.integers(-3, 4, (2000, 64))  # many ties
    few = close[rng.integers(0, 2000, 8)]
    small = centroids.Simplex(close[:16])
    number, distance = centroids.nearest(small, close, small.apexes(close), few)
    exact = ((close[:, None] - few[None]) ** 2).sum(2)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_apex_distances_bound_the_distance():
    rng = np.random.default_rng(1)
    data = rng.integers(-2000, 2000, (60, 64))
    simplex = centroids.Simplex(data[:12])
    a = simplex.apexes(data)
    true = ((data[:, None] - data[None]) ** 2).sum(2)
    along = ((a[:, None, :-1] - a[None, :, :-1]) ** 2).sum(2)
    low, high = along + (a[:, None, -1] - a[None, :, -1]) ** 2, along + (a[:, None, -1] + a[None, :, -1]) ** 2
    assert (low <= true * (1 + 1e-9) + 1e-3).all() and (true <= high * (1 + 1e-9) + 1e-3).all()
    pivot_rows = [int(np.flatnonzero((data == p).all(1))[0]) for p in simplex.pivots]
    assert np.allclose(low[:, pivot_rows], true[:, pivot_rows], rtol=1e-6, atol=1)
