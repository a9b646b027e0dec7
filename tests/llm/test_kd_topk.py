import math

import numpy as np
import pytest

from tablekit.llm import kd_topk as K


def brute(rows, asks, k):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, w) in enumerate(kept):
        if asks(q):
            s = sorted((-sum(x * y for x, y in zip(w, v)), i) for other, (i, v) in enumerate(kept)
                       if other != at and len(v) == len(w))
            out += [(q, r + 1, i, -score) for r, (score, i) in enumerate(s[:k])]
    return sorted(out)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, rank int, score string")


def result(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_shards_and_blocks(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(600):
        v = np.round(rng.normal(size=6) * (0.2 if i % 3 else 3.0), 2)
        if i % 4 == 0:
            v = np.array([0.5, 0.25, -0.5, 1.0, 0.0, 2.0])         # a third or so are one vector: many ties
        rows.append((i, [float(x) for x in v]))
    df = frame(spark, [(*r, 0, 1, "s") for r in rows], "double")
    got = K.top_k(df, "id % 7 = 0", k=10, per_shard=40, per_block=9)
    assert result(got) == brute(rows, lambda q: q % 7 == 0, 10)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [0.5, 9.0]), (100, None), (200, [nan, 1.0]), (300, [inf, 1.0]), (400, [None, 1.0]),
            (None, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (500, [1.0, 1.0, 1.0]),
            (3, [1.0, 0.0, 0.0]), (600, [2.0e6, -3.0e6]), (700, []), (4, [])]
    df = frame(spark, [(*r, 0, 1, "s") for r in rows], "double")
    assert result(K.top_k(df, "id % 100 = 0")) == brute(rows, lambda q: q % 100 == 0, 10)
    assert K.top_k(df.limit(0), "id % 100 = 0").count() == 0
    assert K.top_k(df, "id = 12345").count() == 0


def test_large_components_are_exact(spark):
    rows = [(0, [1.0, 0.0]), (1, [3.0e6, 0.5]), (2, [2.0e6, 0.1])]
    assert result(K.top_k(frame(spark, [(*r, 0, 1, "s") for r in rows], "double"), "id = 0")) == [
        (0, 1, 1, 3145728000000), (0, 2, 2, 2097152000000)]
    huge = [(0, [1e6] * 16), (1, [1e6] * 16)]
    for bad in (huge, [(0, [1e17]), (1, [1.0])]):
        with pytest.raises(Exception, match="beyond a long"):
            K.top_k(frame(spark, [(*r, 0, 1, "s") for r in bad], "double"), "id = 0").collect()
    near = [(0, [3.0e9, -2.0]), (1, [500.0, 1e3]), (2, [-500.0, 2.0]), (3, [2.0, 4.0])]        # products near 2**62
    assert result(K.top_k(frame(spark, [(*r, 0, 1, "s") for r in near], "double"), "id = 0")) == brute(near, lambda q: q == 0, 10)


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(1, [1.0, 2.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [1.0, 1.0]), (2, [0.0, 5.0])]
    assert result(K.top_k(frame(spark, [(*r, 0, 1, "s") for r in rows], "double"), "id = 1", k=3)) == \
        brute(rows, lambda q: q == 1, 3)


def test_far_shards_are_never_sent_queries(spark):
    """Roots are pruned before rows move: clusters far from the queries get none."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=3) * 0.1 + (5.0 if i < 40 else -5.0)]) for i in range(400)]
    df = frame(spark, [(*r, 0, 1, "s") for r in rows], "double")
    assert result(K.top_k(df, "id < 40 AND id % 10 = 0", k=5, per_shard=20, per_block=2)) == \
        brute(rows, lambda q: q < 40 and q % 10 == 0, 5)
    lo, hi = np.array([[1, 1], [-9, -9]]), np.array([[2, 3], [-8, -7]])
    assert K.root_bounds(lo, hi, np.array([[1, 1], [-1, 0]]), 9).tolist() == [[5, -15], [-1, 9]]


def test_tree_boxes_are_tight_and_prune():
    rng = np.random.default_rng(4)
    rows = rng.integers(-50, 50, size=(3000, 3))
    rows[:1500] += 4000
    tree = K.KDTree(np.arange(3000), rows)
    for node in range(len(tree.start)):
        part = tree.rows[tree.start[node]:tree.end[node]]
        assert (part.min(axis=0) == tree.lo[node]).all() and (part.max(axis=0) == tree.hi[node]).all()
    seen = []
    inner = tree.products
    tree.products = lambda r, q: (seen.append(len(r)), inner(r, q))[1]
    tree.search(np.array([1, 1, 1]), -1, 10, None)
    assert sum(seen[2:]) < 1500                                   # the far half is never opened
