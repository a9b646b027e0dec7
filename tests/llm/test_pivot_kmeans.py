import hashlib
import math

import numpy as np
import pytest

from tablekit.llm import pivot_kmeans as P


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<double>, cluster int, v string, distance int")


def brute(rows, clusters, rounds, dims):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    named += sorted(("~", v) for i, v in kept if i is None)
    cents = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        new = []
        for k, c in enumerate(cents):
            mine = [v for (_, v), a in zip(kept, at) if a == k]
            new.append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
        cents = new
    return sorted(((i, k, d) for i, v in kept for d, k in [nearest(v)]), key=str), cents


def result(spark, rows, clusters, rounds, dims):
    done, cents = P.cluster_vectors(frame(spark, rows), clusters, rounds, dims)
    return sorted(map(tuple, done.collect()), key=str), cents


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 0.05), (3, 200.0)])
def test_equals_brute_force(spark, seed, spread):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, 6))
    rows = [(i, [float(x) for x in (middles[i % 5] * 3 if i % 3 else middles[0]) + rng.normal(size=6) * spread * (i % 3 > 0)])
            for i in range(400)]                                          # a third are one vector
    assert result(spark, rows, 8, 4, 6) == brute(rows, 8, 4, 6)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [5.0, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]),
            (5, [1.0]), (6, []), (None, [3.0, 3.0]), (7, [-1e-9, 0.0]), (8, [2.0**42, -(2.0**20)]), (9, [0.0, 0.0])]
    with pytest.raises(Exception, match="beyond"):
        result(spark, rows, 3, 2, 2)
    rows = [r for r in rows if r[0] != 8] + [(8, [2.0**20, -(2.0**20)])]      # far apart, still within a long
    assert result(spark, rows, 3, 3, 2) == brute(rows, 3, 3, 2)
    assert result(spark, rows, 50, 2, 2) == brute(rows, 50, 2, 2)              # fewer vectors than clusters
    assert result(spark, [], 3, 2, 2) == ([], [])
    same = [(i, [1.5, 2.5]) for i in range(20)]
    assert result(spark, same, 4, 2, 2) == brute(same, 4, 2, 2)                # all ties, empty clusters stay


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(4)
    middles = rng.integers(-20000, 20000, size=(8, 6))
    rows = np.concatenate([m + rng.integers(-300, 300, size=(200, 6)) for m in middles])
    cents = middles + 5
    bounds = P.PivotBounds(middles, cents)
    cached = np.stack([np.sqrt(P.squared(rows, p).astype(float)) for p in middles], axis=1)
    exact = np.stack([P.squared(rows, c) for c in cents], axis=1)
    assert (bounds.squared_below(cached) <= exact).all()
    cluster, best, measured = P.assign(rows, cached, cents, bounds)
    assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert measured < 1.5 * len(rows)                                          # of 8 a row
