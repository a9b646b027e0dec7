"""Source / sink queries: each writes a driver table in another format with
Spark, reads it back with the reader under test, and queries it. The write
is part of the work, so it grows with the table."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import scalar as S
from tablekit.plans.registry import register
from tablekit.session import shared_dir, sized_for
from tablekit.sources import (
    ctas,
    empty_like,
    query_path,
    read_csv,
    read_parquet,
    save_table,
    table,
    write_parquet,
    write_sized,
)

ORDERS_CSV_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("OrderDate", T.StringType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def _orders_as_csv(spark, d, date_fmt="MM/dd/yyyy", sep=","):
    o = table(spark, d, "orders")
    out = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   F.date_format("o_orderdate", date_fmt).alias("OrderDate"), "o_orderpriority")
    path = shared_dir(spark, "csv", "orders", unique=True)
    out.write.option("header", "true").option("sep", sep).csv(path)
    return path


@register("csv_explicit_schema", ids=("SRC2", "FN1", "FN2", "AGG3"), sql="""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus, COUNT(*) AS n_orders
    FROM orders GROUP BY order_year, o_orderstatus""")
def csv_explicit_schema(spark, d):
    path = _orders_as_csv(spark, d)
    # explicit schema: no inference pass over the files
    df = read_csv(spark, path, schema=ORDERS_CSV_SCHEMA)
    df = df.withColumn("OrderTs", S.parse_ts("OrderDate", "MM/dd/yyyy")).drop("OrderDate")
    return (df.groupBy(F.year("OrderTs").alias("order_year"), "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n_orders")))


@register("csv_infer_schema", ids=("SRC1", "AGG6"), sql="""
    SELECT c_mktsegment, COUNT(*) AS n_customers, ROUND(SUM(c_acctbal), 2) AS total_balance
    FROM customer GROUP BY c_mktsegment""")
def csv_infer_schema(spark, d):
    path = shared_dir(spark, "csv", "customer", unique=True)
    table(spark, d, "customer").write.option("header", "true").csv(path)
    df = read_csv(spark, path)                  # header + inferSchema, directory input
    return df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"),
                                          F.round(S.money_sum("c_acctbal"), 2).alias("total_balance"))


@register("tsv_infer_join", ids=("SRC3", "JN1"), sql="""
    SELECT n_name, COUNT(*) AS n_suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name""")
def tsv_infer_join(spark, d):
    path = shared_dir(spark, "tsv", "nation", unique=True)
    table(spark, d, "nation").write.option("header", "true").option("sep", "\t").csv(path)
    nat = read_csv(spark, path, sep="\t").alias("n")
    s = table(spark, d, "supplier").alias("s")
    return (s.join(nat, F.col("n.n_nationkey") == F.col("s.s_nationkey"))
            .groupBy("n_name").agg(F.count(F.lit(1)).alias("n_suppliers")))


@register("csv_strings_cast", ids=("SRC4", "FN7", "FLT5"), sql="""
    SELECT o_orderkey, strftime(o_orderdate, '%m%d%H%M') AS date, o_custkey AS custkey, o_totalprice AS price
    FROM orders WHERE strftime(o_orderdate, '%m%d%H%M') LIKE '01%' AND o_totalprice > 100000""")
def csv_strings_cast(spark, d):
    path = _orders_as_csv(spark, d, date_fmt="MMddHHmm")
    # every column read as a string (no inference) -- 'MMddHHmm' keeps its
    # leading zero -- then the numeric ones are try_cast
    df = read_csv(spark, path, infer=False, casts={"o_custkey": "bigint", "o_totalprice": "double"})
    return (df.where(F.expr("OrderDate LIKE '01%' AND o_totalprice > 100000"))
            .select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("OrderDate").alias("date"), F.col("o_custkey").alias("custkey"),
                    F.col("o_totalprice").alias("price")))


@register("json_path_query", ids=("SRC6", "AGG2"), sql="""
    SELECT event_type, COUNT(*) AS n_events, ROUND(SUM(value), 2) AS total_value
    FROM events GROUP BY event_type""")
def json_path_query(spark, d):
    path = shared_dir(spark, "json", "events", unique=True)
    table(spark, d, "events").write.json(path)
    df = query_path(spark, "json", path)        # SELECT * FROM json.`path`
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                        F.round(S.money_sum("value"), 2).alias("total_value"))


@register("empty_like", ids=("SRC7",), sql="SELECT * FROM events WHERE 2 = 1")
def empty_like_q(spark, d):
    return empty_like(table(spark, d, "events"))


@register("parquet_roundtrip", ids=("SNK1", "SRC5"), sql="""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS total_qty
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def parquet_roundtrip(spark, d):
    path = shared_dir(spark, "parquet", "lineitem", unique=True)
    write_parquet(table(spark, d, "lineitem"), path, partition_by=["l_returnflag"])
    df = read_parquet(spark, path)
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), S.money_sum("l_quantity").alias("total_qty"))


@contextmanager
def scratch_database(spark, name="tk_scratch"):
    """A database of its own, in use inside the block, dropped with all its
    tables after it; what was in use before is in use again."""
    db = f"{name}_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {db} LOCATION '{shared_dir(spark, 'warehouse', db, unique=True)}'")
    spark.sql(f"USE {db}")
    try:
        yield db
    finally:
        spark.sql(f"USE {before}")
        spark.sql(f"DROP DATABASE {db} CASCADE")


def _kept(spark, df, name):
    """A result written outside the scratch database, which goes with its tables."""
    return read_parquet(spark, write_parquet(df, shared_dir(spark, "results", name, unique=True)))


@register("ctas_table", ids=("SNK4", "SNK6", "SNK7", "SRC10"), sql="""
    SELECT o_orderpriority, COUNT(*) AS n_orders, ROUND(AVG(o_totalprice), 2) AS avg_price
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def ctas_table(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("tk_orders")
    with scratch_database(spark):
        loc = shared_dir(spark, "tables", "orders_f", unique=True)
        t = ctas(spark, "orders_f", "SELECT * FROM tk_orders WHERE o_orderstatus = 'F'", location=loc)
        return _kept(spark, t.groupBy("o_orderpriority").agg(
            F.count(F.lit(1)).alias("n_orders"), F.round(S.money_avg("o_totalprice"), 2).alias("avg_price")), "ctas")


@register("ctas_default_topk", ids=("SNK5", "SNK6", "WIN1", "SRT4"), sql="""
    WITH t AS (SELECT l_suppkey, l_returnflag, CAST(SUM(l_quantity) AS DOUBLE) AS qty
               FROM lineitem GROUP BY ALL),
    r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY qty DESC) AS INTEGER) AS place FROM t)
    SELECT l_returnflag, l_suppkey, qty, place FROM r WHERE place <= 3""")
def ctas_default_topk(spark, d):
    # CREATE TABLE ... AS without USING, then a ranking over the stored table
    table(spark, d, "lineitem").createOrReplaceTempView("tk_lineitem_src")
    with scratch_database(spark):
        ctas(spark, "flag_totals", "SELECT l_suppkey, l_returnflag, SUM(l_quantity) AS qty FROM tk_lineitem_src"
             " GROUP BY l_suppkey, l_returnflag", using=None)
        return _kept(spark, spark.sql("""
            SELECT * FROM (SELECT l_returnflag, l_suppkey, qty,
                                  dense_rank() OVER (PARTITION BY l_returnflag ORDER BY qty DESC) AS place
                           FROM flag_totals) WHERE place <= 3"""), "topk")


@register("managed_table_modes", ids=("SNK2",), sql="""
    SELECT c_custkey, c_mktsegment, true AS second_refused FROM customer""")
def managed_table_modes(spark, d):
    # a managed table: written, refused while it exists, then overwritten
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    with scratch_database(spark):
        save_table(table(spark, d, "supplier").select("s_suppkey"), "kept")
        try:
            save_table(c, "kept")
            refused = False
        except AnalysisException:
            refused = True
        save_table(c, "kept", mode="overwrite")
        return _kept(spark, spark.table("kept").withColumn("second_refused", F.lit(refused)), "managed")


@register("partition_pruned_scan", ids=("SNK1", "SRC5", "FLT8"), sql="""
    SELECT l_returnflag, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS total_qty
    FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY l_returnflag""")
def partition_pruned_scan(spark, d):
    # written partitioned by ship year; the year filter becomes a partition
    # filter, so only that year's folder is listed and read
    path = shared_dir(spark, "parquet", "lineitem_by_year", unique=True)
    li = table(spark, d, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    write_parquet(li, path, partition_by=["ship_year"])
    df = read_parquet(spark, path).where(F.col("ship_year") == 1998)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                          S.money_sum("l_quantity").alias("total_qty"))


@register("sized_write", ids=("AQE1", "SNK1", "SRC5"), sql="""
    SELECT l_returnflag, COUNT(*) AS n_lines, COUNT(DISTINCT l_orderkey) AS n_orders, true AS few_files
    FROM lineitem GROUP BY l_returnflag""")
def sized_write(spark, d):
    # session sizes from the input's bytes, rows rebalanced by partition before the write
    with sized_for(spark, f"{d}/lineitem.parquet"):
        path = write_sized(table(spark, d, "lineitem"), shared_dir(spark, "parquet", "by_flag", unique=True),
                           ["l_returnflag"])
    back = read_parquet(spark, path)
    files = F.count_distinct(F.col("_metadata.file_path"))
    rows = F.max(F.col("_metadata.file_size"))
    # a partition has one file, unless its files are as large as a partition may get
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_orderkey").alias("n_orders"),
        ((files == 1) | (rows > 16 << 20)).alias("few_files"))
