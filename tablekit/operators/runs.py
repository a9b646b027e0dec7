"""Run tracking and a model registry kept in plain tables.

A run is one row: id, start time, params map, metrics map, artifact path,
tags. Models are rows (name, version, stage, source). Selecting the best
run / latest model are single aggregates (``max_by``), not driver loops.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("artifact_uri", T.StringType(), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
])

MODELS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("stage", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
])


def log_run(spark: SparkSession, runs_path: str, run_id: str, params: Mapping[str, object],
            metrics: Mapping[str, float | None], artifact_uri: str | None = None,
            tags: Mapping[str, str] | None = None, start_time: dt.datetime | None = None) -> str:
    """Appends one run. A metric that could not be computed (None or NaN, as on
    an empty test side) is stored as NULL."""
    row = (run_id, start_time or dt.datetime.now(dt.timezone.utc),
           {k: str(v) for k, v in params.items()},
           {k: None if v is None or v != v else float(v) for k, v in metrics.items()},
           artifact_uri, dict(tags or {}))
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(runs_path)
    return run_id


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(runs_path)


def tidy_runs(runs: DataFrame, metric_keys=("accuracy",), param_keys=("data_version",)) -> DataFrame:
    """Flatten: metrics.<k> -> metrics_<k>, params.<k> -> <k>; nested maps dropped."""
    cols = {f"metrics_{k}": F.col("metrics")[k] for k in metric_keys}
    cols.update({k: F.col("params")[k] for k in param_keys})
    return runs.withColumns(cols).drop("metrics", "params", "tags")


def best_run(runs: DataFrame, metric: str, time_col: str = "start_time",
             id_col: str = "run_id") -> DataFrame:
    """The row with the highest ``metric``; ties go to the newest run, then
    the greatest id. Runs without the metric (NULL or NaN) cannot win. One
    aggregate with partial aggregation -- no sort of the whole table and no
    driver loop."""
    runs = runs.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    order = F.struct(F.col(metric), F.col(time_col), F.col(id_col))
    return runs.agg(F.max_by(F.struct(*[F.col(c) for c in runs.columns]), order).alias("b")) \
        .where("b IS NOT NULL").select("b.*")


def register_model(spark: SparkSession, models_path: str, name: str, version: int, stage: str,
                   source: str) -> None:
    spark.createDataFrame([(name, version, stage, source)], MODELS_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(models_path)


def latest_model(models: DataFrame, name: str, stage: str) -> DataFrame:
    """Highest version of ``name`` in ``stage`` (one row, or none)."""
    m = models.where((F.col("name") == name) & (F.col("stage") == stage))
    return m.groupBy("name", "stage").agg(
        F.max_by(F.struct("version", "source"), F.col("version")).alias("m")) \
        .select("name", "stage", "m.version", "m.source")
