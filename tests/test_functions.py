"""Literal tests on the reference's inline data, and equivalence of the
three spellings of "+1 to each element"."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import arrays as A
from tablekit.functions import scalar as S
from tablekit.functions import udfs as U


def celsius(spark):
    return spark.createDataFrame([([35, 36, 32, 30, 40, 42, 38],), ([31, 32, 34, 55, 56],)],
                                 "celsius array<int>")


def test_map_and_fold_elements(spark):
    rows = celsius(spark).select(
        A.map_elements("celsius", lambda x: x * x - 7 * x).alias("m"),
        A.fold_elements("celsius", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("t"),
        A.fold_elements("celsius", F.lit(0).cast("long"), lambda acc, x: acc + x, lambda acc: -acc).alias("neg")).collect()
    assert rows[1]["m"] == [x * x - 7 * x for x in [31, 32, 34, 55, 56]]
    assert [(r["t"], r["neg"]) for r in rows] == [(253, -253), (208, -208)]


def test_filter_and_exists(spark):
    rows = celsius(spark).select(A.above("celsius", 38).alias("high"),
                                 A.contains_value("celsius", 38).alias("has38")).collect()
    assert rows[0]["high"] == [40, 42]
    assert rows[1]["high"] == [55, 56]
    assert [r["has38"] for r in rows] == [True, False]


def test_exists_is_three_valued(spark):
    df = spark.createDataFrame([([1, None],), ([38, None],)], "v array<int>")
    got = [r[0] for r in df.select(A.contains_value("v", 38)).collect()]
    assert got == [None, True]


INT_ARRAYS = [(1, [1, 2, 3]), (2, [2, 3, 4]), (3, [3, 4, 5]), (4, []), (5, None), (6, [7, None])]


def test_doubling_in_three_spellings(spark):
    df = spark.createDataFrame(INT_ARRAYS, "id int, values array<int>")
    U.register_sql_functions(spark)
    df.createOrReplaceTempView("int_arrays")
    hof = {r["id"]: r["v"] for r in df.select("id", A.map_elements("values", lambda x: 2 * x).alias("v")).collect()}
    sql = {r["id"]: r["v"] for r in spark.sql("SELECT id, doubled_all(values) AS v FROM int_arrays").collect()}
    exploded = {r["id"]: r["v"] for r in
                A.explode_collect(df, "id", "values", lambda v: 2 * v, "v").collect()}
    assert hof[1] == [2, 4, 6] and hof[4] == [] and hof[5] is None and hof[6] == [14, None]
    assert hof == sql
    # explode drops empty / NULL arrays: the reason transform is preferred
    assert {k: v for k, v in hof.items() if v} == exploded


def test_scalar_functions_in_sql_and_pandas(spark):
    U.register_sql_functions(spark)
    df = spark.range(1, 5)
    df.createOrReplaceTempView("some_numbers")
    got = [r[0] for r in spark.sql("SELECT pair_count(id) FROM some_numbers ORDER BY id").collect()]
    assert got == [1, 3, 6, 10]
    assert [r[0] for r in df.orderBy("id").select(U.wheel_slot("id")).collect()] == [22, 2, 19, 36]
    assert U._wheel_slot(pd.Series([1, 2])).tolist() == [22, 2]


def test_sql_function_is_inlined(spark):
    U.register_sql_functions(spark)
    spark.range(1, 9).createOrReplaceTempView("some_numbers")
    plan = spark.sql("SELECT pair_count(id) AS c FROM some_numbers")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_bad_dates_and_casts_are_null(spark):
    df = spark.createDataFrame([("01/02/2018", "12"), ("13/45/2018", "x1"), (None, "99999999999")],
                               "d string, n string")
    got = df.select(S.parse_ts("d", "MM/dd/yyyy").alias("t"),
                    S.safe_cast("n", "int").alias("i")).collect()
    assert str(got[0]["t"]) == "2018-01-02 00:00:00"
    assert got[1]["t"] is None and got[2]["t"] is None
    assert [r["i"] for r in got] == [12, None, None]


def test_ampm_timestamp(spark):
    df = spark.createDataFrame([("01/11/2002 01:51:44 AM",), ("01/11/2002 01:51:44 PM",)], "s string")
    got = [r[0] for r in df.select(S.parse_ts("s", "MM/dd/yyyy hh:mm:ss a")).collect()]
    assert [g.hour for g in got] == [1, 13]


def test_decimal_overflow_is_null(spark):
    df = spark.createDataFrame([(99.5,), (100.25,)], "x double")
    got = [r[0] for r in df.select(S.safe_cast("x", "decimal(4,2)")).collect()]
    assert float(got[0]) == 99.5 and got[1] is None


def test_pick_one_uses_every_choice(spark):
    vals = {r[0] for r in spark.range(2000).select(U.pick_one(["x", "y", "z"], 3)).collect()}
    assert vals == {"x", "y", "z"}


def test_stamp_is_the_clock_unless_fixed(spark):
    import datetime as dt
    fixed = S.stamped(spark.range(1), as_of="2020-02-03 04:05:06").first()
    assert fixed["loaded_at"] == dt.datetime(2020, 2, 3, 4, 5, 6) and fixed["loaded_on"] == dt.date(2020, 2, 3)
    now = S.stamped(spark.range(1)).first()["loaded_at"]
    assert abs((now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 120


def test_collect_sorted_is_ordered(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 5)], "k int, v int")
    got = {r["k"]: r["values"] for r in A.collect_sorted(df, "k", "v").collect()}
    assert got == {1: [1, 2, 3], 2: [5]}


def test_sum_of_squares_on_floats(spark):
    df = spark.createDataFrame([([3.0, 4.0],)], T.StructType([T.StructField(
        "e", T.ArrayType(T.FloatType()))]))
    assert df.select(F.sqrt(A.sum_of_squares("e"))).first()[0] == 5.0


def test_pandas_udf_registered_for_sql(spark):
    U.register_wheel_slot(spark, "slot_vec")
    got = [r[0] for r in spark.sql("SELECT slot_vec(id) FROM range(1, 3) ORDER BY id").collect()]
    assert got == [22, 2]
