"""Writers: Parquet path, catalog table, CTAS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_sized(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> str:
    """A Parquet write whose files come out near the advisory partition size:
    rows are rebalanced first (by the partition columns, if any), small
    shuffle partitions are put together and large ones split at run time. A value
    with a third of the rows is written by as many tasks as its bytes need."""
    parts = partition_by or []
    w = df.hint("rebalance", *parts).write.mode(mode)
    (w.partitionBy(*parts) if parts else w).parquet(path)
    return path


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet",
               bucket_by: tuple[int, list[str]] | None = None) -> str:
    """``saveAsTable``; ``bucket_by=(n, cols)`` pre-partitions for later
    shuffle-free joins / aggregates on ``cols``."""
    w = df.write.mode(mode).format(fmt)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)
    return name


def ctas(spark: SparkSession, name: str, select_sql: str, using: str | None = "parquet",
         location: str | None = None, replace: bool = True) -> DataFrame:
    """CREATE TABLE ... AS; ``using=None`` leaves the format to the session's
    default source."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fmt = f" USING {using}" if using else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name}{fmt}{loc} AS {select_sql}")
    return spark.table(name)


def write_jdbc(df: DataFrame, url: str, dbtable: str, *, driver: str | None = None,
               mode: str = "overwrite", batchsize: int = 10000, **options) -> str:
    w = df.write.format("jdbc").option("url", url).option("dbtable", dbtable) \
        .option("batchsize", str(batchsize)).mode(mode)
    if driver:
        w = w.option("driver", driver)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
    return dbtable
