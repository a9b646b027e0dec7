"""Scalar, date, array and UDF queries.

Arrays come from the data: a per-row int array built from each lineitem row
(no grouping), the sorted line numbers of each order (``array_collect``,
where collecting per key is the operation itself), and the float vectors of
``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.functions import arrays as A
from tablekit.functions import scalar as S
from tablekit.functions import udfs as U
from tablekit.plans.registry import register
from tablekit.sources import table


def order_lines(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return A.collect_sorted(li, "l_orderkey", "l_linenumber").withColumnRenamed(
        "l_orderkey", "id")


ORDER_LINES_SQL = """(SELECT l_orderkey AS id, list_sort(list(l_linenumber)) AS "values"
                      FROM lineitem GROUP BY l_orderkey)"""


def line_readings(spark, d):
    """One int array per lineitem row (line number, quantity, discount and tax
    in percent) -- the per-row array column the higher-order functions work
    on. Built per row, so no grouping, no shuffle, and every array has 4
    elements whatever the key distribution."""
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.array(F.col("l_linenumber"), F.col("l_quantity").cast("int"),
                F.round(F.col("l_discount") * 100).cast("int"),
                F.round(F.col("l_tax") * 100).cast("int")).alias("values"))


READINGS_SQL = """(SELECT l_orderkey, l_linenumber,
    [l_linenumber, CAST(l_quantity AS INTEGER), CAST(ROUND(l_discount * 100) AS INTEGER),
     CAST(ROUND(l_tax * 100) AS INTEGER)] AS "values" FROM lineitem)"""


@register("array_collect", ids=("AGG10",), sql=f"""
    SELECT id, "values" FROM {ORDER_LINES_SQL} t""")
def array_collect(spark, d):
    # collect_list per key is the feature here; the group is an order's lines
    # (line numbers 1..7 in this data model), and partial collection runs
    # before the shuffle
    return order_lines(spark, d)


@register("array_transform", ids=("FN12", "UDF2"), sql=f"""
    SELECT l_orderkey, l_linenumber,
           list_transform("values", lambda x: x * x - 7 * x) AS curve,
           list_transform("values", lambda x: x + 1) AS next_up
    FROM {READINGS_SQL} t""")
def array_transform(spark, d):
    r = line_readings(spark, d)
    return r.select("l_orderkey", "l_linenumber",
                    A.map_elements("values", lambda x: x * x - 7 * x).alias("curve"),
                    A.map_elements("values", lambda x: x + 1).alias("next_up"))


@register("array_filter", ids=("FN13",), sql=f"""
    SELECT l_orderkey, l_linenumber, list_filter("values", lambda t: t > 3) AS high
    FROM {READINGS_SQL} t""")
def array_filter(spark, d):
    return line_readings(spark, d).select("l_orderkey", "l_linenumber",
                                          A.above("values", 3).alias("high"))


@register("array_exists", ids=("FN14",), sql=f"""
    SELECT l_orderkey, l_linenumber, list_bool_or(list_transform("values", lambda t: t = 5)) AS has_five
    FROM {READINGS_SQL} t""")
def array_exists(spark, d):
    return line_readings(spark, d).select("l_orderkey", "l_linenumber",
                                          A.contains_value("values", 5).alias("has_five"))


@register("array_reduce", ids=("FN15", "FN10", "FN8"), sql=f"""
    SELECT l_orderkey, l_linenumber,
           CAST(list_sum("values") // len("values") AS BIGINT) AS mean_floor,
           CAST(len("values") AS INTEGER) AS n
    FROM {READINGS_SQL} t""")
def array_reduce(spark, d):
    return line_readings(spark, d).select(
        "l_orderkey", "l_linenumber",
        A.fold_elements("values", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("total"),
        F.size("values").alias("n")).selectExpr("l_orderkey", "l_linenumber", "total div n AS mean_floor", "n")


@register("explode_collect", ids=("UDF5", "FN11", "AGG10"), sql=f"""
    SELECT l_orderkey, l_linenumber, list_transform("values", lambda x: x + 1) AS new_values
    FROM {READINGS_SQL} t""")
def explode_collect(spark, d):
    # regrouped by the row's own key, so each group is one row's 4 elements
    return A.explode_collect(line_readings(spark, d), ["l_orderkey", "l_linenumber"],
                             "values", lambda v: v + 1, "new_values")


@register("explode_rows", ids=("FN11",), sql=f"""
    SELECT l_orderkey, l_linenumber, unnest("values") AS value FROM {READINGS_SQL} t""")
def explode_rows(spark, d):
    return line_readings(spark, d).select("l_orderkey", "l_linenumber",
                                          F.explode("values").alias("value"))


@register("embedding_norms", ids=("FN15",), sql="""
    SELECT vec_id, label, ROUND(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS norm,
           CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos
    FROM embeddings""")
def embedding_norms(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label",
                    F.round(F.sqrt(A.sum_of_squares("embedding")), 4).alias("norm"),
                    F.size(A.above("embedding", 0)).alias("n_pos"))


# --------------------------------------------------------------------------
# UDF surface
# --------------------------------------------------------------------------
@register("udf_scalar_sql", ids=("UDF1",), sql="""
    SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) * (l_linenumber + 1) // 2 AS pairs
    FROM lineitem""")
def udf_scalar_sql(spark, d):
    U.register_sql_functions(spark)
    table(spark, d, "lineitem").createOrReplaceTempView("tk_lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, pair_count(l_linenumber) AS pairs FROM tk_lineitem")


@register("udf_scalar_pandas", ids=("UDF3",), sql="""
    SELECT l_orderkey, l_linenumber, (17 * CAST(l_linenumber AS BIGINT) + 5) % 37 AS slot
    FROM lineitem""")
def udf_scalar_pandas(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     U.wheel_slot(F.col("l_linenumber").cast("long")).alias("slot"))


@register("udf_array_doubled", ids=("UDF2",), sql=f"""
    SELECT l_orderkey, l_linenumber, list_transform("values", lambda x: 2 * x) AS "values"
    FROM {READINGS_SQL} t""")
def udf_array_doubled(spark, d):
    U.register_sql_functions(spark)
    line_readings(spark, d).createOrReplaceTempView("tk_line_readings")
    return spark.sql("SELECT l_orderkey, l_linenumber, doubled_all(`values`) AS `values` "
                     "FROM tk_line_readings")


SHIFTS = ["early", "late", "night"]


@register("random_state", ids=("UDF4", "FN9"), sql="""
    SELECT event_id, user_id, true AS is_a_shift, true AS in_unit_range FROM events""")
def random_state(spark, d):
    # the picks are random, so what is checked per row is that each is one of the
    # choices and that the plain random number lies in [0, 1)
    ev = table(spark, d, "events").select("event_id", "user_id", U.pick_one(SHIFTS, seed=42).alias("shift"),
                                          F.rand(7).alias("u"))
    return ev.select("event_id", "user_id", F.col("shift").isin(SHIFTS).alias("is_a_shift"),
                     ((F.col("u") >= 0) & (F.col("u") < 1)).alias("in_unit_range"))


AS_OF = "2024-03-01 12:30:00"


@register("as_of_stamp", ids=("FN4", "PRJ5"), sql=f"""
    SELECT c_custkey, TIMESTAMP '{AS_OF}' AS loaded_at, DATE '{AS_OF[:10]}' AS loaded_on, true AS clock_runs
    FROM customer""")
def as_of_stamp(spark, d):
    # a load stamp: the clock by default, a fixed time where a run must be repeatable
    c = S.stamped(table(spark, d, "customer").select("c_custkey"), as_of=AS_OF)
    return c.withColumn("clock_runs", F.current_timestamp().cast("timestamp_ntz") > F.col("loaded_at"))


# --------------------------------------------------------------------------
# Dates, casts
# --------------------------------------------------------------------------
@register("timestamp_parse", ids=("FN1", "FN2", "FN7"), sql="""
    SELECT o_orderkey, d_text,
           try_strptime(d_text, '%m/%d/%Y') AS parsed, CAST(year(try_strptime(d_text, '%m/%d/%Y')) AS INTEGER) AS yr
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '13/45/' || CAST(year(o_orderdate) AS VARCHAR)
                                  ELSE strftime(o_orderdate, '%m/%d/%Y') END AS d_text FROM orders) t""")
def timestamp_parse(spark, d):
    o = table(spark, d, "orders")
    # P-status rows get an impossible date, which must parse to NULL
    txt = F.when(F.col("o_orderstatus") == "P",
                 F.concat(F.lit("13/45/"), F.year("o_orderdate").cast("string"))
                 ).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    t = o.select("o_orderkey", txt.alias("d_text"))
    parsed = S.parse_ts("d_text", "MM/dd/yyyy")
    return t.select("o_orderkey", "d_text", parsed.alias("parsed"), F.year(parsed).alias("yr"))


@register("timestamp_parse_ampm", ids=("FN1",), sql="""
    SELECT event_id, strptime(strftime(ts, '%m/%d/%Y %I:%M:%S %p'), '%m/%d/%Y %I:%M:%S %p') AS parsed
    FROM events""")
def timestamp_parse_ampm(spark, d):
    ev = table(spark, d, "events")
    fmt = "MM/dd/yyyy hh:mm:ss a"
    return ev.select("event_id", S.parse_ts(F.date_format("ts", fmt), fmt).alias("parsed"))


@register("safe_casts", ids=("FN7", "SRC4"), sql="""
    SELECT o_orderkey, TRY_CAST(k_text AS INTEGER) AS k_int, TRY_CAST(p_text AS DOUBLE) AS price
    FROM (SELECT o_orderkey,
                 CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS k_text,
                 CASE WHEN o_orderstatus = 'O' THEN 'x' || CAST(o_orderkey AS VARCHAR)
                      ELSE CAST(o_orderkey * 3 AS VARCHAR) END AS p_text
          FROM orders) t""")
def safe_casts(spark, d):
    o = table(spark, d, "orders")
    t = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a")
        .otherwise(F.col("o_custkey").cast("string")).alias("k_text"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("x"), F.col("o_orderkey").cast("string")))
        .otherwise((F.col("o_orderkey") * 3).cast("string")).alias("p_text"))
    return t.select("o_orderkey", S.safe_cast("k_text", "int").alias("k_int"),
                    S.safe_cast("p_text", "double").alias("price"))


@register("substring_month", ids=("FN6", "AGG2"), sql="""
    SELECT event_type, substring(strftime(ts, '%H%M%S'), 1, 2) AS hour_text, COUNT(*) AS n_events
    FROM events GROUP BY ALL""")
def substring_month(spark, d):
    # a position of 0 counts like 1: the first two characters are the hour
    clock = table(spark, d, "events").select("event_type", F.date_format("ts", "HHmmss").alias("clock"))
    return (clock.groupBy("event_type", F.expr("SUBSTRING(clock, 0, 2)").alias("hour_text"))
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("date_shift", ids=("FN5", "FN8"), sql="""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) - 30 AS reminder_date,
           o_orderkey // 7 AS bucket, o_orderkey * 2 - 1 AS odd_key
    FROM orders""")
def date_shift(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", S.days_before("o_orderdate", 30).alias("reminder_date"),
                    F.expr("o_orderkey div 7").alias("bucket"),
                    (F.col("o_orderkey") * 2 - 1).alias("odd_key"))
