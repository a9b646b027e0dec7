"""Metrics against MLlib's MulticlassMetrics, confusion fill, model round
trip, run selection with ties, latest model in a stage."""

import datetime as dt

import pytest

from tablekit.operators import ml as M
from tablekit.operators import runs as RU


def preds(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_metrics_equal_multiclass_metrics(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics
    p = preds(spark)
    mm = MulticlassMetrics(p.select("prediction", "label").rdd.map(tuple))
    ours = M.metrics(p).first()
    assert ours["accuracy"] == pytest.approx(mm.accuracy)
    assert ours["false_positive_rate"] == pytest.approx(mm.falsePositiveRate(1.0))
    assert ours["false_negative_rate"] == pytest.approx(mm.falsePositiveRate(0.0))


def test_confusion_fills_empty_class(spark):
    p = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    got = {r["label"]: (r["pred_0"], r["pred_1"]) for r in M.confusion(p).collect()}
    assert got == {0.0: (0, 1), 1.0: (0, 1)}
    m = M.metrics(p.where("label = 1")).first()
    assert m["false_positive_rate"] is None                # empty class -> NULL


def test_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a1, b1 = M.split(df.repartition(7), "k", 0.1)
    a2, b2 = M.split(df.repartition(3), "k", 0.1)
    assert sorted(r[0] for r in b1.collect()) == sorted(r[0] for r in b2.collect())
    assert 120 < b1.count() < 280 and a1.count() + b1.count() == 2000


def test_model_roundtrip_and_scoring(spark, scratch):
    sf = "/root/testdata/sf0.001"
    ct = M.with_label(M.churn_table(spark.read.parquet(f"{sf}/customer.parquet"),
                                    spark.read.parquet(f"{sf}/orders.parquet")))
    model = M.fit_churn(ct, max_depth=2, max_iter=3)
    path = M.save_model(model, scratch + "/m")
    a = M.score(model, ct).select("c_custkey", "prediction").collect()
    b = M.score(M.load_model(path), ct).select("c_custkey", "prediction").collect()
    assert sorted(a) == sorted(b)
    scored = M.score_with_lineage(model, ct, "churn", 3, path, "2021-01-01 00:00:00")
    assert {"model_name", "model_version", "model_source", "model_run_timestamp"} <= set(scored.columns)


def test_runs_best_and_latest(spark, scratch):
    p = scratch + "/runs"
    t0 = dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc)
    RU.log_run(spark, p, "r1", {"data_version": "v0", "max_depth": 12}, {"accuracy": 0.9},
               start_time=t0)
    RU.log_run(spark, p, "r2", {"data_version": "v1", "max_depth": 5}, {"accuracy": 0.9},
               start_time=t0 + dt.timedelta(hours=1))
    RU.log_run(spark, p, "r3", {"data_version": "v1", "max_depth": 5}, {"accuracy": 0.8},
               start_time=t0 + dt.timedelta(hours=2))
    tidy = RU.tidy_runs(RU.read_runs(spark, p), ("accuracy",), ("data_version", "max_depth"))
    assert "metrics" not in tidy.columns and "metrics_accuracy" in tidy.columns
    best = RU.best_run(tidy, "metrics_accuracy").first()
    assert best["run_id"] == "r2"                          # tie -> newest
    # a run without a metric never wins
    RU.log_run(spark, p, "r4", {"data_version": "v2"}, {"accuracy": float("nan")})
    RU.log_run(spark, p, "r5", {"data_version": "v2"}, {"accuracy": None})
    tidy = RU.tidy_runs(RU.read_runs(spark, p), ("accuracy",), ("data_version",))
    assert RU.best_run(tidy, "metrics_accuracy").first()["run_id"] == "r2"
    now = dt.datetime.now(dt.timezone.utc).timestamp()
    logged = tidy.where("run_id = 'r4'").selectExpr("unix_timestamp(start_time) AS t").first()["t"]
    assert abs(logged - now) < 300                         # the instant, whatever the session's zone
    assert RU.best_run(tidy.where("run_id = 'r5'"), "metrics_accuracy").count() == 0
    m = scratch + "/models"
    RU.register_model(spark, m, "churn", 1, "Staging", "a")
    RU.register_model(spark, m, "churn", 2, "Staging", "b")
    RU.register_model(spark, m, "churn", 3, "Archived", "c")
    got = RU.latest_model(spark.read.parquet(m), "churn", "Staging").first()
    assert (got["version"], got["source"]) == (2, "b")


def test_versions_are_compared_with_models_of_full_length(spark, scratch):
    """Both versions get the default 20 rounds, and the best of the two runs is staged."""
    from tablekit.plans import q_ml
    runs, best = q_ml.compare_versions(spark, q_ml.churn(spark, "/root/testdata/sf0.001"), scratch)
    got = {r["data_version"]: r for r in runs.collect()}
    assert {v: (r["max_depth"], r["rounds"]) for v, r in got.items()} == {"v0": ("12", "20"), "v1": ("5", "20")}
    assert all(len(M.load_model(r["artifact_uri"]).stages[-1].trees) == 20 for r in got.values())
    chosen = max(got.values(), key=lambda r: (r["metrics_accuracy"], r["start_time"], r["run_id"]))
    assert best.collect() == [chosen]
    staged = RU.latest_model(spark.read.parquet(scratch + "/registry"), "churn_gbt", "Staging").first()
    assert (staged["version"], staged["source"]) == (1, chosen["artifact_uri"])


def test_thresholds_of_five_digits_stay_apart(spark, tmp_path):
    """Customers with 12345 and 1234 orders give two runs with their own thresholds."""
    from tablekit.plans import q_ml
    d = str(tmp_path)
    spark.createDataFrame([(1, 0, 1.0, "A"), (2, 0, 1.0, "A")],
                          "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(d + "/customer.parquet")
    from pyspark.sql import functions as F
    spark.range(12345 + 1234).select(
        F.when(F.col("id") < 12345, 1).otherwise(2).cast("long").alias("o_custkey"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit(1.0).alias("o_totalprice"),
        F.lit("5-LOW").alias("o_orderpriority")).write.parquet(d + "/orders.parquet")
    got = {r["run_id"]: r["threshold"] for r in q_ml.threshold_runs(spark, d).collect()}
    assert got == {"rule_lt_1234": 1234, "rule_lt_12345": 12345}


def test_histogram(spark):
    df = spark.createDataFrame([(1.0,), (150.0,), (220.0,), (None,)], "x double")
    got = {r["bucket_lo"]: r["n"] for r in M.histogram(df, "x", 100).collect()}
    assert got == {0.0: 1, 100.0: 1, 200.0: 1}


def test_class_balance(spark):
    from tablekit.operators.relational import class_balance
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "churn boolean")
    r = class_balance(df, "churn").first()
    assert (r["n_total"], r["n_pos"], r["n_neg"]) == (4, 2, 2)
