"""Product-limit table, concordance and trees as a table, against plain Python and the model."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablekit.operators import ml as M
from tablekit.operators import survival as SV
from tablekit.operators import tree_table as TT


def sample(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["x", "y", None]), rng.choice([rng.randint(1, 12), 5]), rng.choice([True, False, None]),
             rng.choice([rng.randint(-40, 40), 7])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, t int, e boolean, s long")


@pytest.mark.parametrize("seed", [1, 2])
def test_kaplan_meier(spark, seed):
    rows = sample(seed, 120) + [("z", 3, True, 1), ("z", 3, True, 1), ("w", None, True, 1)]      # z: nobody is left
    got = {(r.g, r.time): r for r in SV.kaplan_meier(frame(spark, rows), "t", "e", ["g"]).collect()}
    want = 0
    for g in {r[0] for r in rows}:
        s, v = 1.0, 0.0
        for t in sorted({r[1] for r in rows if r[0] == g and r[1] is not None}):
            n = sum(r[0] == g and r[1] is not None and r[1] >= t for r in rows)
            d = sum(r[0] == g and r[1] == t and r[2] is True for r in rows)
            s *= 1 - d / n
            v += d / (n * (n - d)) if n > d else 0
            r = got[g, t]
            assert (r.n_risk, r.n_events) == (n, d)
            assert math.isclose(r.survival, s, abs_tol=1e-12) and math.isclose(r.std_err, s * math.sqrt(v), abs_tol=1e-12)
            want += 1
    assert len(got) == want
    assert SV.kaplan_meier(frame(spark, []), "t", "e").count() == 0


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_concordance_equals_all_pairs(spark, seed):
    rows = sample(seed, 90) + [("x", None, True, 3), ("x", 3, True, None)]
    full = [r for r in rows if r[1] is not None and r[3] is not None]
    pairs = [(a, b) for a in full for b in full if a[2] and a[1] < b[1]]
    want = (len(pairs), sum(a[3] > b[3] for a, b in pairs), sum(a[3] == b[3] for a, b in pairs))
    got = SV.concordance(frame(spark, rows), "t", "e", "s").first()
    assert tuple(map(int, got[:3])) == want
    assert math.isclose(got.c_index, (want[1] + want[2] / 2) / want[0])


def test_concordance_edges(spark):
    assert tuple(SV.concordance(frame(spark, []), "t", "e", "s").first())[:3] == (0, 0, 0)
    same = frame(spark, [("x", t, True, 4) for t in range(5)])
    r = SV.concordance(same, "t", "e", "s").first()
    assert (int(r.comparable), int(r.concordant), int(r.tied), r.c_index) == (10, 0, 10, 0.5)
    wide = frame(spark, [("x", 1, True, 2**62), ("x", 2, True, -(2**61))])
    assert SV.concordance(wide, "t", "e", "s").first().c_index == 1.0


def test_trees_as_a_table_score_like_the_model(spark, scratch):
    rng = random.Random(6)
    rows = [(i, rng.gauss(0, 1), float(rng.randint(0, 5)), float(rng.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, a double, b double, label double")
    path = M.save_model(M.fit_churn(df, ["a", "b"], max_depth=4, max_iter=6), scratch + "/m")
    nodes = TT.tree_nodes(spark, path)
    assert nodes.select("tree").distinct().count() == 6
    assert nodes.where("left IS NULL").where("feature IS NOT NULL OR threshold IS NOT NULL").count() == 0
    scored = M.score(M.load_model(path), df).select("k", "a", "b", vector_to_array("rawPrediction")[1].alias("want"),
                                                    F.col("prediction").alias("class"))
    got = TT.score_with_trees(scored, nodes, ["a", "b"], depth=4)
    assert got.where("abs(margin - want) > 1e-12 OR prediction <> class").count() == 0 and got.count() == 300
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    # a change in one leaf shows
    other = nodes.withColumn("value", F.when((F.col("tree") == 0) & F.col("left").isNull(), F.col("value") + 1).otherwise(F.col("value")))
    assert TT.score_with_trees(scored, other, ["a", "b"], depth=4).where("abs(margin - want) > 0.5").count() == 300
