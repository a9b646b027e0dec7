"""Generated fact / dimension tables with a hot key (Spark jobs, seeded).

``skewed_sales`` reproduces the shape of the adaptive-execution demo: one
item id carries ``hot_share`` of all sales rows. The rows are produced by
``spark.range`` in parallel, so the generator scales with the cluster.
Used by tests and the bench -- registered queries read the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def items(spark: SparkSession, n_items: int, seed: int = 7, partitions: int | None = None) -> DataFrame:
    """i_item_id 0..n-1, i_price uniform int 0..999."""
    df = spark.range(0, n_items, numPartitions=partitions) if partitions else spark.range(n_items)
    return df.select(F.col("id").alias("i_item_id"),
                     (F.rand(seed) * 1000).cast("int").alias("i_price"))


def skewed_sales(spark: SparkSession, n_sales: int, n_items: int, hot_key: int = 100,
                 hot_share: float = 0.8, days: int = 360, as_of: str = "2021-06-01",
                 seed: int = 11, partitions: int | None = None) -> DataFrame:
    """s_item_id (``hot_share`` of rows on ``hot_key``), s_quantity 0..99,
    s_date within ``days`` before ``as_of`` (fixed so runs are repeatable)."""
    df = spark.range(0, n_sales, numPartitions=partitions) if partitions else spark.range(n_sales)
    item = F.when(F.rand(seed) < hot_share, F.lit(hot_key)) \
        .otherwise((F.rand(seed + 1) * n_items).cast("int"))
    return df.select(
        item.cast("int").alias("s_item_id"),
        (F.rand(seed + 2) * 100).cast("int").alias("s_quantity"),
        F.date_add(F.lit(as_of).cast("date"), -(F.rand(seed + 3) * days).cast("int")).alias("s_date"),
    )
