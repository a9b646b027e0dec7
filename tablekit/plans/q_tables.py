"""DML and versioned-table queries on ``customer``.

The pure DML functions are checked directly against SQL; the versioned
queries keep every version as rows with from_version / to_version, written
under the shared scratch folder and read back, so time travel, restore and
repair are checked end to end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablekit.operators import commits as CM
from tablekit.operators import dml
from tablekit.operators import partitioned as PT
from tablekit.operators import versions as V
from tablekit.plans.registry import register
from tablekit.session import shared_dir
from tablekit.sources import read_parquet, table, write_parquet

NEW_KEY_OFFSET = 1_000_000_000   # suppliers become new customers above this key
DELETE_COND = "c_acctbal < 0"
UPDATE_COND = "c_nationkey = 3"


def customers(spark, d):
    return table(spark, d, "customer")


def merge_source(spark, d):
    """Changed rows (AUTOMOBILE customers, balance + 100) and new rows
    (suppliers re-keyed above NEW_KEY_OFFSET)."""
    c = customers(spark, d)
    changed = (c.where(F.col("c_mktsegment") == "AUTOMOBILE")
               .withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100, 2)))
    s = table(spark, d, "supplier")
    new = s.select((F.col("s_suppkey") + NEW_KEY_OFFSET).alias("c_custkey"),
                   F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
                   F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"))
    return changed.unionByName(new)


MERGE_SOURCE_SQL = f"""(
    SELECT c_custkey, c_name, c_nationkey, ROUND(c_acctbal + 100, 2) AS c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
    UNION ALL
    SELECT s_suppkey + {NEW_KEY_OFFSET}, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)"""

DELETED_SQL = f"SELECT * FROM customer WHERE NOT coalesce({DELETE_COND}, false)"
UPDATED_SQL = f"""SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN coalesce({UPDATE_COND}, false) THEN 0.0 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN coalesce({UPDATE_COND}, false) THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""
MERGED_SQL = f"""SELECT * FROM customer t WHERE NOT EXISTS
    (SELECT 1 FROM {MERGE_SOURCE_SQL} s WHERE s.c_custkey = t.c_custkey)
    UNION ALL SELECT * FROM {MERGE_SOURCE_SQL} s2"""


def _update(df):
    return dml.update_where(df, UPDATE_COND, {"c_acctbal": 0.0, "c_mktsegment": "REVIEW"})


@register("delete_where", ids=("DML1", "EDA2"), sql=DELETED_SQL)
def delete_where(spark, d):
    return dml.delete_where(customers(spark, d), DELETE_COND)


@register("update_where", ids=("DML2",), sql=UPDATED_SQL)
def update_where(spark, d):
    return _update(customers(spark, d))


@register("merge_upsert", ids=("DML3", "JN6"), sql=MERGED_SQL)
def merge_upsert(spark, d):
    return dml.merge_upsert(customers(spark, d), merge_source(spark, d), ["c_custkey"])


def credit_rows(spark, d):
    s = table(spark, d, "supplier")
    return s.select((F.col("s_suppkey") + NEW_KEY_OFFSET).alias("c_custkey"),
                    F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
                    F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"),
                    (F.col("s_nationkey") * 10 + 600).alias("credit_score"))


@register("append_evolve", ids=("VER8", "SET2"), sql=f"""
    SELECT *, CAST(NULL AS INTEGER) AS credit_score FROM customer
    UNION ALL
    SELECT s_suppkey + {NEW_KEY_OFFSET}, s_name, s_nationkey, s_acctbal, 'SUPPLIER',
           CAST(s_nationkey * 10 + 600 AS INTEGER) FROM supplier""")
def append_evolve(spark, d):
    return dml.append(customers(spark, d), credit_rows(spark, d), evolve=True)


@register("snapshot_diff", ids=("VER9",), sql=f"""
    (SELECT *, 'delete' AS change FROM (SELECT * FROM customer EXCEPT ALL {UPDATED_SQL}) a)
    UNION ALL
    (SELECT *, 'insert' AS change FROM ({UPDATED_SQL} EXCEPT ALL SELECT * FROM customer) b)""")
def snapshot_diff(spark, d):
    c = customers(spark, d)
    return dml.diff(c, _update(c))


# --------------------------------------------------------------------------
# Versions as data: rows with from_version / to_version, written as Parquet
# --------------------------------------------------------------------------
def _saved(spark, v):
    """The versioned rows after a change, written and read back."""
    return read_parquet(spark, write_parquet(v, shared_dir(spark, "versions", "customer", unique=True)))


@register("time_travel", ids=("VER1", "VER2", "DML1", "DML2"), sql=DELETED_SQL)
def time_travel(spark, d):
    v = V.first_version(customers(spark, d))
    v = V.delete_where(v, 1, DELETE_COND)
    v = V.update_where(v, 2, UPDATE_COND, {"c_acctbal": 0.0})
    return V.as_of(_saved(spark, v), 1)


@register("time_travel_timestamp", ids=("VER2",), sql=DELETED_SQL)
def time_travel_timestamp(spark, d):
    v = V.first_version(customers(spark, d))
    v = V.delete_where(v, 1, DELETE_COND)
    v = V.update_where(v, 2, UPDATE_COND, {"c_acctbal": 0.0})
    commits = spark.createDataFrame([(n, dt.datetime(2024, 1, 1 + n, tzinfo=dt.timezone.utc)) for n in range(3)],
                                    "version int, committed_at timestamp")
    version = V.version_at(commits, dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc))
    return V.as_of(_saved(spark, v), version)


@register("time_travel_latest", ids=("VER2", "DML3", "JN6"), sql=MERGED_SQL)
def time_travel_latest(spark, d):
    v = V.merge(V.first_version(customers(spark, d)), 1, merge_source(spark, d), ["c_custkey"])
    return V.latest(_saved(spark, v))


@register("restore_version", ids=("VER6", "VER8"), sql="SELECT *, CAST(NULL AS INTEGER) AS credit_score FROM customer")
def restore_version(spark, d):
    v = V.first_version(customers(spark, d))
    v = V.append(v, 1, credit_rows(spark, d), evolve=True)     # adds a column
    v = V.delete_where(v, 2, DELETE_COND)
    v = V.restore(v, 3, to=0)
    return V.latest(_saved(spark, v))


@register("dml_repair", ids=("DML4", "SET2"), sql="SELECT * FROM customer")
def dml_repair(spark, d):
    v = _saved(spark, V.delete_where(V.first_version(customers(spark, d)), 1, UPDATE_COND))
    # what the delete took is put back from the version before it
    v = V.append(v, 2, V.as_of(v, 0).where(UPDATE_COND))
    return V.latest(v)


@register("append_refused", ids=("VER7",), sql="SELECT *, true AS refused FROM customer")
def append_refused(spark, d):
    v = V.first_version(customers(spark, d))
    try:
        v, refused = V.append(v, 1, credit_rows(spark, d)), False
    except dml.SchemaMismatch:
        refused = True
    return V.latest(v).withColumn("refused", F.lit(refused))


@register("table_history", ids=("VER1",), sql=f"""
    SELECT * FROM (VALUES
      (0, 'CREATE TABLE AS SELECT'), (1, 'DELETE'), (2, 'UPDATE'), (3, 'MERGE')) v(version, operation)
    JOIN (
      SELECT 0 AS version, (SELECT COUNT(*) FROM customer) AS num_output_rows
      UNION ALL SELECT 1, (SELECT COUNT(*) FROM ({DELETED_SQL}) x)
      UNION ALL SELECT 2, (SELECT COUNT(*) FROM ({DELETED_SQL}) x)
      UNION ALL SELECT 3, (SELECT COUNT(*) FROM ({DELETED_SQL}) x WHERE c_custkey NOT IN
                             (SELECT c_custkey FROM {MERGE_SOURCE_SQL} s))
                         + (SELECT COUNT(*) FROM {MERGE_SOURCE_SQL} s)
    ) m USING (version)""")
def table_history(spark, d):
    v = V.first_version(customers(spark, d))
    v = V.delete_where(v, 1, DELETE_COND)
    v = V.update_where(v, 2, UPDATE_COND, {"c_acctbal": 0.0})
    v = V.merge(v, 3, merge_source(spark, d), ["c_custkey"])
    names = ["CREATE TABLE AS SELECT", "DELETE", "UPDATE", "MERGE"]
    return (V.row_counts(v, range(len(names)))
            .withColumn("operation", F.element_at(F.array(*map(F.lit, names)), F.col("version") + 1))
            .select("version", "operation", "num_output_rows"))


@register("partitioned_table_dml", ids=("DML1", "DML2", "SRC5", "SNK1"), sql=f"""
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN coalesce({UPDATE_COND}, false) THEN 0.0 ELSE c_acctbal END AS c_acctbal,
           c_mktsegment
    FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def partitioned_table_dml(spark, d):
    # partitioned by segment: the delete is a partition filter, the deleted folder is never read
    path = write_parquet(customers(spark, d), shared_dir(spark, "parquet", "customer_by_segment", unique=True),
                         partition_by=["c_mktsegment"])
    left = dml.delete_where(read_parquet(spark, path), "c_mktsegment = 'BUILDING'")
    return dml.update_where(left, UPDATE_COND, {"c_acctbal": 0.0})


# --------------------------------------------------------------------------
# Commits as data, the change feed, and changes that rewrite few partitions
# --------------------------------------------------------------------------
V1_SQL = DELETED_SQL
V2_SQL = f"""SELECT c_custkey, c_name, c_nationkey, CASE WHEN coalesce({UPDATE_COND}, false) THEN 0.0 ELSE c_acctbal END AS c_acctbal,
    c_mktsegment FROM ({V1_SQL}) u"""
V3_SQL = f"""SELECT * FROM ({V2_SQL}) t WHERE NOT EXISTS (SELECT 1 FROM {MERGE_SOURCE_SQL} s WHERE s.c_custkey = t.c_custkey)
    UNION ALL SELECT * FROM {MERGE_SOURCE_SQL} s2"""
V4_SQL = "SELECT * FROM customer"


def _committed_customers(spark, d):
    """Five commits on customer, each written with its row of the commits table."""
    base = shared_dir(spark, "versions", "commits", unique=True)
    log = base + "/commits"
    source = merge_source(spark, d)
    v = CM.save(V.first_version(customers(spark, d)), base + "/v0", log, 0, "CREATE")
    v = CM.save(V.delete_where(v, 1, DELETE_COND), base + "/v1", log, 1, "DELETE", DELETE_COND)
    v = CM.save(V.update_where(v, 2, UPDATE_COND, {"c_acctbal": 0.0}), base + "/v2", log, 2, "UPDATE", UPDATE_COND)
    v = CM.save(V.merge(v, 3, source, ["c_custkey"]), base + "/v3", log, 3, "MERGE", "c_custkey")
    v = CM.save(V.restore(v, 4, to=0), base + "/v4", log, 4, "RESTORE")
    return v, CM.read(spark, log)


def _step_sql(n, before, after):
    return f"""SELECT {n} AS version, (SELECT COUNT(*) FROM ({after} EXCEPT ALL {before}) x) AS rows_added,
        (SELECT COUNT(*) FROM ({before} EXCEPT ALL {after}) y) AS rows_closed, (SELECT COUNT(*) FROM ({after}) z) AS rows_live"""


#: What a commit did, told from the rows it changed.
HISTORY_SQL = f"""
    WITH steps AS (
      SELECT 0 AS version, COUNT(*) AS rows_added, 0 AS rows_closed, COUNT(*) AS rows_live FROM customer
      UNION ALL {_step_sql(1, "SELECT * FROM customer", V1_SQL)}
      UNION ALL {_step_sql(2, f"SELECT * FROM ({V1_SQL}) a", f"SELECT * FROM ({V2_SQL}) b")}
      UNION ALL {_step_sql(3, f"SELECT * FROM ({V2_SQL}) a", f"SELECT * FROM ({V3_SQL}) b")}
      UNION ALL {_step_sql(4, f"SELECT * FROM ({V3_SQL}) a", V4_SQL)})
    SELECT version, rows_added, rows_closed, rows_live,
           CASE WHEN rows_added = rows_live AND rows_closed = 0 THEN 'CREATE' WHEN rows_added = 0 THEN 'DELETE'
                WHEN rows_added = rows_closed THEN 'UPDATE' WHEN rows_added > rows_closed AND rows_live > (SELECT COUNT(*) FROM customer)
                THEN 'MERGE' ELSE 'RESTORE' END AS operation,
           CAST(row_number() OVER (ORDER BY version) AS INTEGER) AS nth_by_time
    FROM steps"""


@register("commit_history", ids=("VER4", "VER1", "VER6"), sql=HISTORY_SQL)
def commit_history(spark, d):
    _, commits = _committed_customers(spark, d)
    by_time = Window.orderBy("committed_at")           # one row a commit
    return commits.select("version", "rows_added", "rows_closed", "rows_live", "operation",
                          F.row_number().over(by_time).alias("nth_by_time"))


@register("change_feed", ids=("VER9",), sql=f"""
    (SELECT *, 'delete' AS change FROM (SELECT * FROM customer EXCEPT ALL SELECT * FROM ({V3_SQL}) a) x)
    UNION ALL
    (SELECT *, 'insert' AS change FROM (SELECT * FROM ({V3_SQL}) b EXCEPT ALL SELECT * FROM customer) y)""")
def change_feed(spark, d):
    v, _ = _committed_customers(spark, d)
    return V.net_changes(v, 0, 3)


@register("change_feed_steps", ids=("VER9", "VER4"), sql=f"""
    SELECT version, change, COUNT(*) AS n, SUM(CAST(ROUND(c_acctbal * 100) AS BIGINT)) AS cents FROM (
      SELECT 2 AS version, 'delete' AS change, c_acctbal FROM (SELECT * FROM ({V1_SQL}) a EXCEPT ALL SELECT * FROM ({V2_SQL}) b) p
      UNION ALL SELECT 2, 'insert', c_acctbal FROM (SELECT * FROM ({V2_SQL}) a EXCEPT ALL SELECT * FROM ({V1_SQL}) b) q
      UNION ALL SELECT 3, 'delete', c_acctbal FROM (SELECT * FROM ({V2_SQL}) a EXCEPT ALL SELECT * FROM ({V3_SQL}) b) r
      UNION ALL SELECT 3, 'insert', c_acctbal FROM (SELECT * FROM ({V3_SQL}) a EXCEPT ALL SELECT * FROM ({V2_SQL}) b) s) f
    GROUP BY ALL""")
def change_feed_steps(spark, d):
    v, _ = _committed_customers(spark, d)
    return V.changes(v, 1, 3).groupBy("version", "change").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"))


MIDDLE_SQL = "(SELECT min(o_orderdate) + (max(o_orderdate) - min(o_orderdate)) / 2 FROM orders)"


@register("as_of_order_date", ids=("VER3", "VER2", "VER4"), sql=f"""
    WITH batches AS (SELECT year(o_orderdate) AS y, max(o_orderdate) AS last_at FROM orders GROUP BY ALL)
    SELECT o_orderpriority, COUNT(*) AS n, SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS cents
    FROM orders JOIN batches ON year(o_orderdate) = y WHERE last_at <= {MIDDLE_SQL} GROUP BY ALL""")
def as_of_order_date(spark, d):
    # each year's orders are a commit of their own, at the time of its last order;
    # read back as of the middle of all orders
    orders = table(spark, d, "orders")
    base = shared_dir(spark, "versions", "orders", unique=True)
    years = [r[0] for r in orders.select(F.year("o_orderdate").alias("y")).where("y is not null").distinct().orderBy("y").collect()]
    for n, y in enumerate(years):
        mine = (F.col("o_orderdate") >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (
            F.col("o_orderdate") < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        CM.add_rows(orders.where(mine), base + "/rows", base + "/commits", n, "o_orderdate")
    span = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    middle = span.select((F.col("a") + (F.col("b") - F.col("a")) / 2).cast("timestamp")).scalar()
    rows = CM.as_of_time(read_parquet(spark, base + "/rows"), CM.read(spark, base + "/commits"), middle)
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


def _by_segment(spark, d):
    return PT.create(customers(spark, d), shared_dir(spark, "tables", "by_segment", unique=True), ["c_mktsegment"])


IN_PLACE_DELETE = "c_mktsegment = 'BUILDING' OR (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)"
IN_PLACE_UPDATE = "c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 3"


@register("delete_in_place", ids=("DML1",), sql=f"SELECT * FROM customer WHERE NOT coalesce({IN_PLACE_DELETE}, false)")
def delete_in_place(spark, d):
    t = _by_segment(spark, d)
    PT.delete_in_place(t, IN_PLACE_DELETE)         # one partition goes, one is written anew
    return t.read()


@register("update_in_place", ids=("DML2",), sql=f"""
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN coalesce({IN_PLACE_UPDATE}, false) THEN 0.0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN coalesce({IN_PLACE_UPDATE}, false) THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def update_in_place(spark, d):
    t = _by_segment(spark, d)
    PT.update_in_place(t, IN_PLACE_UPDATE, {"c_acctbal": 0.0, "c_mktsegment": "REVIEW"})
    return t.read()


@register("merge_in_place", ids=("DML3", "JN6"), sql=MERGED_SQL)
def merge_in_place(spark, d):
    t = _by_segment(spark, d)
    source = read_parquet(spark, write_parquet(merge_source(spark, d), shared_dir(spark, "parquet", "changes", unique=True)))
    PT.merge_in_place(t, source, ["c_custkey"])
    return t.read()
