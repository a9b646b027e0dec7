"""Skew queries. The skew is derived from the driver's lineitem: every line
with quantity <= 40 (about 80 % of lines) is re-keyed to part 100, the shape
of the adaptive-execution demo's sales table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators import skew as SK
from tablekit.plans.q_relational import exact_sales
from tablekit.plans.registry import register
from tablekit.sources import table

HOT_PART = 100
HOT_QTY = 40
SKEWED_KEY_SQL = f"CASE WHEN l_quantity <= {HOT_QTY} THEN {HOT_PART} ELSE l_partkey END"
SKEWED_JOIN_SQL = f"""
    SELECT l_shipdate, ROUND(SUM(l_quantity * p_retailprice), 2) AS total_sales
    FROM (SELECT *, {SKEWED_KEY_SQL} AS item_id FROM lineitem) s
    JOIN part ON item_id = p_partkey
    GROUP BY l_shipdate ORDER BY total_sales DESC"""


def skewed_sales(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return li.withColumn("item_id", F.expr(SKEWED_KEY_SQL))


@register("hot_keys", ids=("AQE3", "AGG2"), sql=f"""
    WITH c AS (SELECT {SKEWED_KEY_SQL} AS key, COUNT(*) AS n FROM lineitem GROUP BY key),
         t AS (SELECT SUM(n) AS total FROM c)
    SELECT key, n, n / total AS share FROM c, t WHERE n >= 0.001 * total""")
def hot_keys(spark, d):
    return SK.hot_keys(skewed_sales(spark, d), "item_id", min_share=0.001)


@register("skewed_join_sum", ids=("JN4", "AGG7", "AQE1"), sql=SKEWED_JOIN_SQL)
def skewed_join_sum(spark, d):
    # plain join: AQE's skew-join split handles the hot partition at run time
    s = skewed_sales(spark, d)
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return (s.join(p, s.item_id == p.p_partkey).groupBy("l_shipdate")
            .agg(exact_sales("l_quantity").alias("total_sales"))
            .orderBy(F.desc("total_sales")))


@register("salted_join_sum", ids=("AQE4", "JN4"), sql=SKEWED_JOIN_SQL)
def salted_join_sum(spark, d):
    s = skewed_sales(spark, d)
    salts = SK.hot_key_salts(s, "item_id", min_share=0.05)
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    j = SK.salted_join(s, p, "item_id", "p_partkey", salts, row_id=["l_orderkey", "l_linenumber"])
    return (j.groupBy("l_shipdate")
            .agg(exact_sales("l_quantity").alias("total_sales"))
            .orderBy(F.desc("total_sales")))


@register("preagg_join_sum", ids=("JN4", "AQE4", "AGG7"), sql=SKEWED_JOIN_SQL)
def preagg_join_sum(spark, d):
    # sum(q * price(item)) by day = sum over (item, day) of price(item) * sum(q):
    # collapsing the fact side to one row per (item, day) before the join (with
    # partial aggregation below that shuffle) leaves the hot item with one row
    # per day, so no join task sees the skew at all.
    s = skewed_sales(spark, d)
    per_item_day = s.groupBy("item_id", "l_shipdate").agg(F.sum("l_quantity").alias("q"))
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    j = per_item_day.join(p, per_item_day.item_id == p.p_partkey)
    return (j.groupBy("l_shipdate")
            .agg(exact_sales("q").alias("total_sales"))
            .orderBy(F.desc("total_sales")))
