"""Churn model and run-tracking queries.

The churn table is derived from customer + orders. Metrics of a fixed
rule-based prediction and the rule's threshold "runs" are SQL-checked, as is all
of the trained models' output but the predicted values; those are checked by
scoring every row again from the trees as a table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablekit.operators import ml as M
from tablekit.operators import runs as RU
from tablekit.operators import survival as SV
from tablekit.operators import tree_table as TT
from tablekit.operators import versions as V
from tablekit.operators.relational import class_balance
from tablekit.plans.registry import register
from tablekit.session import shared_dir
from tablekit.sources import read_parquet, table, write_parquet

CUT = M.CUTOFF
RULE_MAX_ORDERS = 8   # rule: fewer than this many orders before the cutoff -> churn
RUN_EPOCH = "2024-01-01 00:00:00"

CHURN_SQL = f"""(
  WITH per AS (
    SELECT o_custkey AS c_custkey,
      COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUT}') AS n_orders,
      SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderdate < TIMESTAMP '{CUT}') AS cents,
      COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUT}' AND o_orderpriority = '1-URGENT') AS n_urgent,
      COUNT(*) FILTER (WHERE NOT (o_orderdate < TIMESTAMP '{CUT}')) AS n_after,
      MIN(o_orderdate) AS first_order,
      MAX(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{CUT}') AS last_before
    FROM orders GROUP BY o_custkey)
  SELECT c.c_custkey, c_nationkey, c_acctbal, c_mktsegment,
    COALESCE(n_orders, 0) AS n_orders, COALESCE(cents, 0) / 100.0 AS spend,
    COALESCE(n_urgent, 0) AS n_urgent, COALESCE(ROUND(cents / n_orders), 0) / 100.0 AS avg_price,
    COALESCE(n_after, 0) = 0 AS churn,
    CAST(COALESCE(datediff('day', first_order, COALESCE(last_before, TIMESTAMP '{CUT}')), 0) AS INTEGER)
      AS tenure_days
  FROM customer c LEFT JOIN per p ON c.c_custkey = p.c_custkey)"""

RULE_SQL = f"""(SELECT *, CASE WHEN churn THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
                CASE WHEN n_orders < {RULE_MAX_ORDERS} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
                FROM {CHURN_SQL} ct)"""

RUNS_SQL = f"""(
  WITH h AS (SELECT n_orders, COUNT(*) FILTER (WHERE churn) AS pos,
                    COUNT(*) FILTER (WHERE NOT churn) AS neg
             FROM {CHURN_SQL} ct GROUP BY n_orders),
  c AS (SELECT n_orders,
          COALESCE(SUM(pos) OVER (ORDER BY n_orders ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
          COALESCE(SUM(neg) OVER (ORDER BY n_orders ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
          SUM(pos) OVER () AS tot_pos, SUM(neg) OVER () AS tot_neg FROM h)
  SELECT 'rule_lt_' || CAST(n_orders AS VARCHAR) AS run_id,
         TIMESTAMP '{RUN_EPOCH}' + n_orders * INTERVAL 1 MINUTE AS start_time,
         CAST(n_orders AS INTEGER) AS threshold, 'v0' AS data_version,
         ROUND((pos_below + tot_neg - neg_below) / (tot_pos + tot_neg), 6) AS metrics_accuracy,
         ROUND(neg_below / tot_neg, 6) AS metrics_fpr,
         ROUND((tot_pos - pos_below) / tot_pos, 6) AS metrics_fnr
  FROM c)"""


def churn(spark, d):
    return M.churn_table(table(spark, d, "customer"), table(spark, d, "orders"))


def rule_predictions(spark, d):
    ct = M.with_label(churn(spark, d))
    return ct.withColumn("prediction",
                         F.when(F.col("n_orders") < RULE_MAX_ORDERS, 1.0).otherwise(0.0))


@register("churn_features", ids=("ML1", "CSE2", "PRJ2"), sql=f"SELECT * FROM {CHURN_SQL} t")
def churn_features(spark, d):
    return churn(spark, d)


@register("churn_balance", ids=("AGG13", "FLT7"), sql=f"""
    SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE churn) AS n_pos,
           COUNT(*) FILTER (WHERE NOT churn) AS n_neg FROM {CHURN_SQL} t""")
def churn_balance(spark, d):
    return class_balance(churn(spark, d), "churn")


@register("rule_confusion", ids=("ML5",), sql=f"""
    SELECT label, COUNT(*) FILTER (WHERE prediction = 0) AS pred_0,
           COUNT(*) FILTER (WHERE prediction = 1) AS pred_1
    FROM {RULE_SQL} r GROUP BY label""")
def rule_confusion(spark, d):
    return M.confusion(rule_predictions(spark, d))


@register("rule_metrics", ids=("ML6",), sql=f"""
    SELECT ROUND(AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
           ROUND(AVG(CASE WHEN label = 0 THEN CASE WHEN prediction = 1 THEN 1.0 ELSE 0.0 END END), 6)
             AS false_positive_rate,
           ROUND(AVG(CASE WHEN label = 1 THEN CASE WHEN prediction = 0 THEN 1.0 ELSE 0.0 END END), 6)
             AS false_negative_rate,
           COUNT(*) AS n
    FROM {RULE_SQL} r""")
def rule_metrics(spark, d):
    m = M.metrics(rule_predictions(spark, d))
    return m.select(*[F.round(c, 6).alias(c) for c in
                      ("accuracy", "false_positive_rate", "false_negative_rate")], "n")


@register("acctbal_histogram", ids=("EDA1",), sql="""
    SELECT floor(c_acctbal / 1000) * 1000 AS bucket_lo, COUNT(*) AS n FROM customer
    WHERE c_acctbal IS NOT NULL GROUP BY bucket_lo""")
def acctbal_histogram(spark, d):
    return M.histogram(table(spark, d, "customer"), "c_acctbal", 1000)


def threshold_runs_table(spark, d):
    """One run per candidate threshold of the rule, with params / metrics
    maps. The counts come from a per-value histogram and running sums over
    it (no cross join of thresholds with rows). The running sums are ordered
    over the histogram, which has one row per distinct order count."""
    ct = churn(spark, d)
    h = ct.groupBy("n_orders").agg(F.count_if("churn").alias("pos"),
                                    F.count_if(~F.col("churn")).alias("neg"))
    below = Window.orderBy("n_orders").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    c = h.select(
        "n_orders",
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("pos_below"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("neg_below"),
        F.sum("pos").over(everything).alias("tot_pos"),
        F.sum("neg").over(everything).alias("tot_neg"))
    # a share of an empty class is NULL
    acc = F.try_divide(F.col("pos_below") + F.col("tot_neg") - F.col("neg_below"), F.col("tot_pos") + F.col("tot_neg"))
    fpr = F.try_divide(F.col("neg_below"), F.col("tot_neg"))
    fnr = F.try_divide(F.col("tot_pos") - F.col("pos_below"), F.col("tot_pos"))
    return c.select(
        F.concat(F.lit("rule_lt_"), F.col("n_orders").cast("string")).alias("run_id"),
        (F.lit(RUN_EPOCH).cast("timestamp_ntz")
         + F.make_dt_interval(mins=F.col("n_orders").cast("int"))).alias("start_time"),
        F.create_map(F.lit("threshold"), F.col("n_orders").cast("string"),
                     F.lit("data_version"), F.lit("v0")).alias("params"),
        F.create_map(F.lit("accuracy"), F.round(acc, 6), F.lit("fpr"), F.round(fpr, 6),
                     F.lit("fnr"), F.round(fnr, 6)).alias("metrics"),
        F.lit(None).cast("string").alias("artifact_uri"),
        F.create_map().cast("map<string,string>").alias("tags"),
    )


def tidy(spark, d):
    t = RU.tidy_runs(threshold_runs_table(spark, d), metric_keys=("accuracy", "fpr", "fnr"),
                     param_keys=("data_version", "threshold"))
    return t.withColumn("threshold", F.col("threshold").cast("int")).drop("artifact_uri")


@register("threshold_runs", ids=("RUN2", "PRJ7"), sql=f"SELECT * FROM {RUNS_SQL} r")
def threshold_runs(spark, d):
    return tidy(spark, d)


@register("best_run", ids=("RUN3", "SRT5", "AGG11", "FLT10"), sql=f"""
    SELECT run_id, threshold, metrics_accuracy FROM {RUNS_SQL} r
    ORDER BY metrics_accuracy DESC, start_time DESC, run_id DESC LIMIT 1""")
def best_run(spark, d):
    return RU.best_run(tidy(spark, d), "metrics_accuracy").select(
        "run_id", "threshold", "metrics_accuracy")


@register("latest_model", ids=("RUN4",), sql=f"""
    SELECT 'churn_rule' AS name, 'Staging' AS stage, threshold AS version,
           'runs:/' || run_id || '/model' AS source
    FROM {RUNS_SQL} r WHERE metrics_accuracy >= 0.5 ORDER BY threshold DESC LIMIT 1""")
def latest_model(spark, d):
    models = tidy(spark, d).select(
        F.lit("churn_rule").alias("name"), F.col("threshold").alias("version"),
        F.when(F.col("metrics_accuracy") >= 0.5, "Staging").otherwise("Archived").alias("stage"),
        F.concat(F.lit("runs:/"), "run_id", F.lit("/model")).alias("source"))
    return RU.latest_model(models, "churn_rule", "Staging")


# --------------------------------------------------------------------------
# Trained models. What a model predicts has no SQL form; its keys, labels, split
# side, lineage columns and run rows have, and are compared.
# --------------------------------------------------------------------------
TEST_SHARE = 0.1
SIDE_SQL = f"CASE WHEN {M.SPLIT_SQL.format(key='c_custkey')} < {int(TEST_SHARE * M.SPLIT_PARTS)} THEN 'test' ELSE 'train' END"


def _train_and_log(spark, data, version_tag, depth, runs_path, model_dir):
    """Trains with ``fit_churn``'s default rounds, logs the run, returns the model's path."""
    labelled = M.with_label(data)
    train, test = M.split(labelled, "c_custkey", TEST_SHARE)
    model = M.fit_churn(train, max_depth=depth)
    path = M.save_model(model, f"{model_dir}/{version_tag}")
    m = M.metrics(M.score(M.load_model(path), test)).first()
    RU.log_run(spark, runs_path, f"gbt_{version_tag}",
               {"data_version": version_tag, "max_depth": depth, "rounds": model.stages[-1].getNumTrees,
                "n_train": train.count(), "n_test": m["n"]},
               {k: m[k] for k in ("accuracy", "false_positive_rate", "false_negative_rate")},
               artifact_uri=path)
    return path


@register("gbt_churn_scores", ids=("ML2", "ML3", "ML4", "ML7", "ML9"), sql=f"""
    SELECT c_custkey, CASE WHEN churn THEN 1.0 ELSE 0.0 END::DOUBLE AS label, {SIDE_SQL} AS side,
           true AS is_a_class, 'churn_gbt' AS model_name, 1 AS model_version, true AS has_source,
           TIMESTAMP '{RUN_EPOCH}' AS model_run_timestamp
    FROM {CHURN_SQL} t""")
def gbt_churn_scores(spark, d):
    base = shared_dir(spark, "ml", "churn", unique=True)
    data = read_parquet(spark, write_parquet(churn(spark, d), f"{base}/churn_table"))      # computed once
    path = _train_and_log(spark, data, "v0", 5, f"{base}/runs", f"{base}/models")
    scored = M.score_with_lineage(M.load_model(path), M.with_label(data),
                                  "churn_gbt", 1, path, RUN_EPOCH)
    saved = read_parquet(spark, write_parquet(scored.select(
        "c_custkey", "label", "prediction", "model_name", "model_version", "model_source",
        "model_run_timestamp"), f"{base}/scores"))
    return saved.select("c_custkey", "label", M.split_side("c_custkey", TEST_SHARE).alias("side"),
                        F.col("prediction").isin(0.0, 1.0).alias("is_a_class"), "model_name", "model_version",
                        (F.length("model_source") > 0).alias("has_source"),
                        F.col("model_run_timestamp").cast("timestamp_ntz").alias("model_run_timestamp"))


@register("gbt_compare_versions", ids=("ML8", "VER2", "EDA2", "RUN1", "RUN2", "RUN3", "SRC14", "FN4"), sql=f"""
    WITH v AS (SELECT 'v0' AS data_version, 12 AS max_depth, t.* FROM {CHURN_SQL} t
               UNION ALL SELECT 'v1', 5, t.* FROM {CHURN_SQL} t WHERE NOT coalesce(c_acctbal > 9000, false))
    SELECT 'gbt_' || data_version AS run_id, data_version, max_depth,
           COUNT(*) FILTER (WHERE {SIDE_SQL} = 'train') AS n_train,
           COUNT(*) FILTER (WHERE {SIDE_SQL} = 'test') AS n_test,
           COUNT(*) FILTER (WHERE {SIDE_SQL} = 'test') > 0 AS has_accuracy, true AS started_before_now,
           1 AS n_chosen, true AS chosen_is_best FROM v GROUP BY ALL""")
def gbt_compare_versions(spark, d):
    runs, best = compare_versions(spark, churn(spark, d), shared_dir(spark, "ml", "compare", unique=True))
    # the chosen run beside every run: no other may be more accurate
    chosen = best.select(F.col("run_id").alias("chosen_id"), F.col("metrics_accuracy").alias("chosen_accuracy"),
                         F.lit(1).alias("one"))
    both = runs.withColumn("one", F.lit(1)).join(F.broadcast(chosen), "one", "left")       # one row at most
    everything = Window.partitionBy()                                                      # a row a run
    return both.select("run_id", "data_version", F.col("max_depth").cast("int").alias("max_depth"),
                       F.col("n_train").cast("long").alias("n_train"), F.col("n_test").cast("long").alias("n_test"),
                       F.coalesce(F.col("metrics_accuracy").between(0, 1), F.lit(False)).alias("has_accuracy"),
                       (F.col("start_time") <= F.current_timestamp()).alias("started_before_now"),
                       F.count_if(F.col("run_id") == F.col("chosen_id")).over(everything).cast("int").alias("n_chosen"),
                       F.coalesce(F.col("metrics_accuracy") <= F.col("chosen_accuracy"), F.lit(False)).alias("chosen_is_best"))


@register("gbt_tree_table", ids=("ML3", "ML4", "ML7"), sql=f"""
    SELECT c_custkey, CASE WHEN churn THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS same_margin, true AS same_prediction
    FROM {CHURN_SQL} t""")
def gbt_tree_table(spark, d):
    # the saved model's trees, read as a table, must score every customer as the model does
    base = shared_dir(spark, "ml", "trees", unique=True)
    data = M.with_label(read_parquet(spark, write_parquet(churn(spark, d), f"{base}/churn_table")))
    path = M.save_model(M.fit_churn(M.split(data, "c_custkey", TEST_SHARE)[0], max_depth=5), f"{base}/model")
    own = vector_to_array(F.col("rawPrediction"))[1]
    wanted = (M.score(M.load_model(path), data)
              .select("c_custkey", "label", *M.FEATURES[1:5], "c_acctbal", "c_nationkey", own.alias("model_margin"),
                      F.col("prediction").alias("model_prediction")))
    got = TT.score_with_trees(wanted, TT.tree_nodes(spark, path), M.FEATURES, depth=5)
    return got.select("c_custkey", "label", (F.abs(F.col("margin") - F.col("model_margin")) < 1e-9).alias("same_margin"),
                      (F.col("prediction") == F.col("model_prediction")).alias("same_prediction"))


TIMED_SQL = f"(SELECT c_custkey, c_mktsegment, n_orders, greatest(tenure_days, 0) + 1 AS days, churn FROM {CHURN_SQL} t)"


def timed(spark, d):
    return churn(spark, d).withColumn("days", F.greatest(F.col("tenure_days"), F.lit(0)) + 1)


@register("survival_table", ids=("ML10",), sql=f"""
    WITH per AS (
      SELECT c_mktsegment, days AS time, COUNT(*) FILTER (WHERE churn) AS n_events, COUNT(*) FILTER (WHERE NOT churn) AS n_censored
      FROM {TIMED_SQL} x GROUP BY ALL
    ), risk AS (
      SELECT *, CAST(SUM(n_events + n_censored) OVER (PARTITION BY c_mktsegment ORDER BY time DESC) AS BIGINT) AS n_risk FROM per
    ), run AS (
      SELECT *, MIN(n_risk - n_events) OVER w AS least_left,
             SUM(CASE WHEN n_risk > n_events THEN ln((n_risk - n_events) / n_risk) END) OVER w AS logs,
             SUM(CASE WHEN n_risk > n_events THEN n_events / (n_risk * (n_risk - n_events)) END) OVER w AS spread
      FROM risk WINDOW w AS (PARTITION BY c_mktsegment ORDER BY time)
    )
    SELECT c_mktsegment, time, n_risk, n_events, n_censored,
           ROUND(CASE WHEN least_left = 0 THEN 0.0 ELSE exp(logs) END, 9) AS survival,
           ROUND(CASE WHEN least_left = 0 THEN 0.0 ELSE exp(logs) * sqrt(spread) END, 9) AS std_err
    FROM run""")
def survival_table(spark, d):
    t = SV.kaplan_meier(timed(spark, d), "days", "churn", ["c_mktsegment"])
    return t.withColumns({"survival": F.round("survival", 9), "std_err": F.round("std_err", 9)})


@register("survival_concordance", ids=("ML10",), sql=f"""
    WITH p AS (
      SELECT COUNT(*) AS comparable, COUNT(*) FILTER (WHERE a.score > b.score) AS concordant,
             COUNT(*) FILTER (WHERE a.score = b.score) AS tied
      FROM (SELECT days, -n_orders AS score FROM {TIMED_SQL} x WHERE churn) a
      JOIN (SELECT days, -n_orders AS score FROM {TIMED_SQL} y) b ON a.days < b.days)
    SELECT comparable, concordant, tied,
           ROUND(CASE WHEN comparable > 0 THEN (concordant + tied / 2) / comparable END, 9) AS c_index FROM p""")
def survival_concordance(spark, d):
    # few orders as the sign of early churn
    risky = timed(spark, d).withColumn("score", -F.col("n_orders"))
    return SV.concordance(risky, "days", "churn", "score").select(
        *[F.col(c).cast("long").alias(c) for c in ("comparable", "concordant", "tied")], F.round("c_index", 9).alias("c_index"))


def compare_versions(spark, data, base):
    """Trains on both versions of ``data`` (v1: outliers trimmed) under the
    folder ``base`` and chooses between them: (tidy runs, the best of them).
    The chosen run's model is registered as the staged one."""
    v = V.delete_where(V.first_version(data), 1, "c_acctbal > 9000")
    v = read_parquet(spark, write_parquet(v, f"{base}/churn_table"))
    runs_path, models = f"{base}/runs", f"{base}/models"
    _train_and_log(spark, V.as_of(v, 0), "v0", 12, runs_path, models)
    _train_and_log(spark, V.as_of(v, 1), "v1", 5, runs_path, models)
    runs = RU.tidy_runs(RU.read_runs(spark, runs_path), ("accuracy",),
                        ("data_version", "max_depth", "rounds", "n_train", "n_test"))
    best = RU.best_run(runs, "metrics_accuracy")
    for chosen in best.collect():          # no row if no run has an accuracy
        RU.register_model(spark, f"{base}/registry", "churn_gbt", 1, "Staging", chosen["artifact_uri"])
    return runs, best


@register("survival_model", ids=("ML10",), sql=f"""
    SELECT c_custkey, greatest(tenure_days, 0) + 1.0::DOUBLE AS tenure,
           CASE WHEN churn THEN 1.0 ELSE 0.0 END::DOUBLE AS censor, true AS expects_a_time
    FROM {CHURN_SQL} t""")
def survival_model(spark, d):
    ct = churn(spark, d).withColumn("censor", F.col("churn").cast("double")) \
        .withColumn("tenure", F.greatest(F.col("tenure_days"), F.lit(0)).cast("double") + 1.0)
    model = M.fit_survival(ct, M.FEATURES, "tenure", "censor")
    return model.transform(ct).select("c_custkey", "tenure", "censor",
                                      (F.col("prediction") > 0).alias("expects_a_time"))
