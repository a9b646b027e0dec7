"""The commits of a versioned table, as a table.

A commit writes the rows of its change and, from counts that Spark observes
while it writes them, one row: version, time, operation, predicate and how many
rows were added, closed and live. History is that table; reading by time looks
the version up in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators import versions as V

COMMITS = ("version int, committed_at timestamp, operation string, predicate string,"
           " rows_added long, rows_closed long, rows_live long")


def _log(spark: SparkSession, commits: str, version: int, operation: str, predicate: str | None, at, counts) -> None:
    row = (version, at or dt.datetime.now(dt.timezone.utc), operation, predicate, *counts)
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(commits)


def save(v: DataFrame, path: str, commits: str, version: int, operation: str, predicate: str | None = None,
         at: dt.datetime | None = None) -> DataFrame:
    """Writes the versioned rows ``v``, changed by ``version``, to the new folder
    ``path``, logs the commit and returns the stored rows."""
    spark, seen = v.sparkSession, Observation(f"commit_{version}")
    (v.observe(seen, F.count_if(F.col("from_version") == version).alias("added"),
               F.count_if(F.col("to_version") == version).alias("closed"),
               F.count_if(F.col("to_version").isNull()).alias("live"))
     .write.parquet(path))
    _log(spark, commits, version, operation, predicate, at, [seen.get[k] for k in ("added", "closed", "live")])
    return spark.read.schema(v.schema).parquet(path)


def add_rows(rows: DataFrame, path: str, commits: str, version: int, time_column: str | None = None,
             operation: str = "APPEND") -> None:
    """Commits an append: writes the new rows only, as files of their own. The
    commit's time is the latest of ``time_column``, if given, else now."""
    spark, seen = rows.sparkSession, Observation(f"commit_{version}")
    latest = F.col(time_column).cast("timestamp") if time_column else F.lit(None).cast("timestamp")
    before = _live_before(spark, commits, version)
    (V.added(rows, version).observe(seen, F.count(F.lit(1)).alias("added"), F.max(latest).alias("at"))
     .write.mode("append").parquet(path))
    _log(spark, commits, version, operation, None, seen.get["at"], [seen.get["added"], 0, before + seen.get["added"]])


def _live_before(spark: SparkSession, commits: str, version: int) -> int:
    if version == 0:
        return 0
    return read(spark, commits).where(F.col("version") == version - 1).first()["rows_live"]


def read(spark: SparkSession, commits: str) -> DataFrame:
    return spark.read.schema(T._parse_datatype_string(COMMITS)).parquet(commits)


def as_of_time(v: DataFrame, commits: DataFrame, when: Column | dt.datetime) -> DataFrame:
    """The table as it was at a time: the newest version committed by then, looked
    up inside the plan. No row if nothing was committed by then."""
    when = when if isinstance(when, Column) else F.lit(when)
    version = commits.where(F.col("committed_at") <= when).agg(F.max("version")).scalar()
    return v.where(V.live_at(version)).drop(*V.SPAN)
