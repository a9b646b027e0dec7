"""The churn notebook's flow end to end on a small inline CSV: inferred
CSV -> yes/no booleans -> labels (NULL churn -> 0.0) -> versioned table ->
outlier trim as a new version -> one model per version, runs logged -> best
run -> latest model in a stage."""

import os

from pyspark.sql import functions as F

from tablekit.operators import ml as M
from tablekit.operators import relational as R
from tablekit.operators import runs as RU
from tablekit.operators import versions as V
from tablekit.sources import read_csv

HEADER = ("state,account_length,international_plan,voice_mail_plan,total_day_calls,"
          "total_eve_calls,total_night_calls,total_intl_calls,number_customer_service_calls,churn")
FEATS = ["account_length", "total_day_calls", "total_eve_calls", "total_night_calls",
         "total_intl_calls", "number_customer_service_calls"]


def churn_csv(scratch):
    d = scratch.replace("file:", "") + "/churn_csv"
    os.makedirs(d, exist_ok=True)
    lines = [HEADER]
    for i in range(120):
        churn = "yes" if i % 3 == 0 else ("no" if i % 7 else "")
        lines.append(f"S{i % 5},{60 + (i * 7) % 200 + (100 if i in (5, 50) else 0)},"
                     f"{'yes' if i % 4 == 0 else 'no'},{'no' if i % 2 else 'yes'},"
                     f"{80 + i % 40},{90 + i % 30},{100 + i % 20},{i % 10},{i % 6},{churn}")
    with open(d + "/part-0.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    return scratch + "/churn_csv"


def test_churn_flow(spark, scratch):
    raw = read_csv(spark, churn_csv(scratch))                        # header + inferred
    assert dict(raw.dtypes)["account_length"] == "int"
    df = raw.withColumns({c: R.yes_no(c) for c in ("international_plan", "voice_mail_plan",
                                                    "churn")})
    assert df.where(F.col("churn").isNull()).count() > 0             # NULL churn kept
    bal = R.class_balance(df, "churn").first()
    assert bal["n_total"] == 120 and bal["n_pos"] == 40 and bal["n_neg"] == 80
    labelled = df.withColumn("label", R.label01("churn"))
    assert labelled.where("churn IS NULL AND label = 0.0").count() == \
        df.where(F.col("churn").isNull()).count()

    labelled = labelled.withColumn("row_id", F.monotonically_increasing_id())
    V.delete_where(V.first_version(labelled), 1, "account_length > 220").write.parquet(scratch + "/churn_tbl")
    t = spark.read.parquet(scratch + "/churn_tbl")                   # v1: outliers trimmed
    assert V.as_of(t, 0).count() - V.as_of(t, 1).count() == \
        V.as_of(t, 0).where("account_length > 220").count() > 0

    runs_path, models_path = scratch + "/runs", scratch + "/models"
    for version, depth in ((0, 4), (1, 2)):
        train, test = M.split(V.as_of(t, version), "row_id", 0.25)
        model = M.fit_churn(train, features=FEATS, max_depth=depth, max_iter=3)
        m = M.metrics(M.score(model, test)).first()
        path = M.save_model(model, f"{scratch}/model_v{version}")
        RU.log_run(spark, runs_path, f"run_v{version}",
                   {"data_version": f"v{version}", "max_depth": depth},
                   {"accuracy": m["accuracy"]}, artifact_uri=path)
        RU.register_model(spark, models_path, "churn", version + 1, "Staging", path)
    tidy = RU.tidy_runs(RU.read_runs(spark, runs_path), ("accuracy",), ("data_version",))
    best = RU.best_run(tidy, "metrics_accuracy").first()
    assert best["run_id"] in ("run_v0", "run_v1")
    latest = RU.latest_model(spark.read.parquet(models_path), "churn", "Staging").first()
    assert latest["version"] == 2
    scored = M.score_with_lineage(M.load_model(latest["source"]), V.latest(t), "churn",
                                  latest["version"], latest["source"], "2021-01-01 00:00:00")
    assert scored.count() == V.latest(t).count() and "prediction" in scored.columns
