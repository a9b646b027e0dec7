"""Churn-style model work on DataFrames: feature table, stable split,
gradient-boosted trees, scoring with lineage columns, confusion matrix and
rates, histograms, and a survival (time-to-churn) model.

Training and scoring are MLlib estimators (distributed); metrics are plain
aggregates, so they can be checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.relational import label01
from tablekit.session import shared_dir

CUTOFF = "2001-01-01"   # orders before: features; none on or after: churned
FEATURES = ["c_acctbal", "n_orders", "spend", "n_urgent", "avg_price", "c_nationkey"]


def churn_table(customer: DataFrame, orders: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """One row per customer: history before ``cutoff`` and a churn flag
    (no order on or after it). One grouped pass over orders with conditional
    aggregates (partial aggregation map-side), then a join on the key."""
    before = F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz")
    per = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(before).alias("n_orders"),
        # money summed in integer cents: exact, so independent of summation order
        F.sum(F.when(before, F.round(F.col("o_totalprice") * 100).cast("long"))).alias("cents"),
        F.count_if(before & (F.col("o_orderpriority") == "1-URGENT")).alias("n_urgent"),
        F.count_if(~before).alias("n_after"),
        F.min("o_orderdate").alias("first_order"),
        F.max(F.when(before, F.col("o_orderdate"))).alias("last_before"),
    )
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    t = c.join(per, "c_custkey", "left")
    return t.select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        (F.coalesce("cents", F.lit(0)) / 100.0).alias("spend"),
        F.coalesce("n_urgent", F.lit(0)).alias("n_urgent"),
        (F.coalesce(F.round(F.try_divide("cents", "n_orders")), F.lit(0.0)) / 100.0).alias("avg_price"),
        (F.coalesce("n_after", F.lit(0)) == 0).alias("churn"),
        F.coalesce(F.datediff(F.coalesce("last_before", F.lit(cutoff).cast("timestamp_ntz")),
                              "first_order"), F.lit(0)).alias("tenure_days"),
    )


def with_label(df: DataFrame, flag: str = "churn", label: str = "label") -> DataFrame:
    return df.withColumn(label, label01(flag))


#: A whole-number key's place on a wheel of SPLIT_PARTS, by a multiplicative
#: generator that SQL can compute as well.
SPLIT_PARTS = 1000
SPLIT_SQL = "((({key} % 2147483647) + 2147483647) % 2147483647) * 48271 % 2147483647 % 1000"


def split_side(key: str, test_fraction: float = 0.1) -> Column:
    """'test' or 'train' for a row, from its key alone: the same row always
    lands on the same side, whatever the partitioning (``randomSplit`` depends
    on it)."""
    place = F.expr(SPLIT_SQL.format(key=f"CAST(`{key}` AS BIGINT)"))
    return F.when(place < int(test_fraction * SPLIT_PARTS), "test").otherwise("train")


def split(df: DataFrame, key: str, test_fraction: float = 0.1):
    """Train / test split by a whole-number ``key`` (see :func:`split_side`)."""
    side = split_side(key, test_fraction)
    return df.where(side == "train"), df.where(side == "test")


def fit_churn(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label",
              max_depth: int = 5, max_iter: int = 20, seed: int = 7) -> PipelineModel:
    """VectorAssembler + GBTClassifier pipeline. Tree-ensemble checkpoints
    (every 10 iterations, cutting lineage) go to the shared checkpoint dir."""
    shared_dir(train.sparkSession)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth,
                        maxIter=max_iter, seed=seed, checkpointInterval=10)
    return Pipeline(stages=[asm, gbt]).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_with_lineage(model: PipelineModel, df: DataFrame, name: str, version: int,
                       source: str, run_ts: str) -> DataFrame:
    """Batch scoring output with the model's lineage columns."""
    out = score(model, df).drop("features", "rawPrediction", "probability")
    return out.withColumns({
        "model_name": F.lit(name), "model_version": F.lit(version),
        "model_source": F.lit(source),
        "model_run_timestamp": F.lit(run_ts).cast("timestamp"),
    })


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows = true class, columns = predicted class 0 / 1 (0 where empty)."""
    return (pred.groupBy(F.col(label).cast("double").alias(label))
            .pivot(prediction, [0.0, 1.0]).count()
            .withColumnsRenamed({"0.0": "pred_0", "1.0": "pred_1"})
            .fillna(0, ["pred_0", "pred_1"]))


def metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, FP share of the negatives, FN share of the positives (NULL
    when that class is empty), in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.avg(F.when(y == 0, (p == 1).cast("double"))).alias("false_positive_rate"),
        F.avg(F.when(y == 1, (p == 0).cast("double"))).alias("false_negative_rate"),
        F.count(F.lit(1)).alias("n"),
    )


def histogram(df: DataFrame, col: str, width: float) -> DataFrame:
    """Counts per fixed-width bucket [lo, lo + width)."""
    lo = F.floor(F.col(col) / width) * width
    return (df.where(F.col(col).isNotNull()).groupBy(lo.cast("double").alias("bucket_lo"))
            .agg(F.count(F.lit(1)).alias("n")))


def fit_survival(df: DataFrame, features: Sequence[str], time_col: str, censor_col: str):
    """Accelerated-failure-time model of time to churn (censor = 1: churned)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    aft = AFTSurvivalRegression(labelCol=time_col, censorCol=censor_col, featuresCol="features")
    return Pipeline(stages=[asm, aft]).fit(df)
