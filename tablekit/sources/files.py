"""Batch readers: CSV / TSV / JSON / Parquet / JDBC, and file queries by path.

All readers return lazy DataFrames, so Catalyst pushes filters and column
pruning into the scan (Parquet row groups, JDBC WHERE clauses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``table(spark, d, "orders")``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("parquet").load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", infer: bool | None = None,
             casts: dict[str, str] | None = None, **options) -> DataFrame:
    """CSV / TSV scan.

    * ``schema`` given: no inference pass over the data (the cheap path for
      big inputs).
    * no schema: ``infer`` defaults to True (header + inferred types).
    * ``casts``: read everything as string, then ``try_cast`` the named
      columns -- bad values become NULL instead of failing the job.
    """
    r = spark.read.option("header", str(header).lower()).option("sep", sep)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        df = r.schema(schema).csv(path)
    else:
        if infer is None:
            infer = not casts
        df = r.option("inferSchema", str(bool(infer)).lower()).csv(path)
    for c, typ in (casts or {}).items():
        df = df.withColumn(c, F.expr(f"try_cast(`{c}` AS {typ})"))
    return df


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              **options) -> DataFrame:
    r = spark.read
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def query_path(spark: SparkSession, fmt: str, path: str, where: str | None = None) -> DataFrame:
    """``SELECT * FROM fmt.`path` [WHERE ...]`` -- query files in place."""
    sql = f"SELECT * FROM {fmt}.`{path}`"
    if where:
        sql += f" WHERE {where}"
    return spark.sql(sql)


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with ``df``'s schema. Catalyst folds ``WHERE false`` into an
    empty LocalRelation, so no file is scanned beyond schema resolution."""
    return df.where(F.lit(False))


def read_jdbc(spark: SparkSession, url: str, dbtable: str, *, driver: str | None = None,
              user: str | None = None, password: str | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10000) -> DataFrame:
    """JDBC scan; with ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries (one task each)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
    r = r.option("fetchsize", str(fetchsize))
    if driver:
        r = r.option("driver", driver)
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower, upper and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower)).option("upperBound", str(upper))
             .option("numPartitions", str(num_partitions)))
    return r.load()
