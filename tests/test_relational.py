"""Small helpers of operators.relational and the table sink modes."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablekit.operators import relational as R
from tablekit.plans import QUERIES
from tablekit.sources import save_table


def test_derive_mixes_columns_and_sql(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.5)], "a int, b double")
    out = R.derive(df, {"c": "a * 10", "b": F.col("b") + 1, "d": F.lit("x")})
    assert out.columns == ["a", "b", "c", "d"]
    assert [tuple(r) for r in out.orderBy("a").collect()] == [(1, 3.0, 10, "x"), (2, 4.5, 20, "x")]


def test_yes_no_and_label(spark):
    df = spark.createDataFrame([("yes",), ("No",), (" YES ",), ("maybe",), (None,)], "s string")
    got = [tuple(r) for r in df.select(R.yes_no("s").alias("b"),
                                       R.label01(R.yes_no("s")).alias("y")).collect()]
    assert got == [(True, 1.0), (False, 0.0), (True, 1.0), (None, 0.0), (None, 0.0)]


def test_distinct_count_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "t string")
    assert R.distinct_count(df, "t").first()[0] == 2


def test_top_n_rank_kinds(spark):
    df = spark.createDataFrame([("g", 5), ("g", 5), ("g", 4), ("g", 3)], "k string, v int")
    dense = R.top_n_per_group(df, ["k"], [F.desc("v")], 2, rank="dense").count()
    rank = R.top_n_per_group(df, ["k"], [F.desc("v")], 2, rank="rank").count()
    row = R.top_n_per_group(df, ["k"], [F.desc("v")], 2, rank="row").count()
    assert (dense, rank, row) == (3, 2, 2)


def test_save_table_modes(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tk_rel LOCATION '{scratch}/wh'")
    df = spark.range(3)
    save_table(df, "tk_rel.t")
    with pytest.raises(AnalysisException):
        save_table(df, "tk_rel.t")                       # error if exists (default)
    save_table(spark.range(5), "tk_rel.t", mode="overwrite")
    assert spark.table("tk_rel.t").count() == 5


def test_union_all_keeps_whole_rows_and_repeats(spark, scratch):
    rows = [(1, 7, "F", 500000.0, "2024-01-01", "1-URGENT"), (1, 7, "F", 500000.0, "2024-01-01", "1-URGENT"),
            (2, None, "F", 400000.5, None, "1-URGENT"), (3, 8, "O", 500000.0, "2024-01-01", "1-URGENT"),
            (4, 8, "F", 500000.0, "2024-01-01", "2-HIGH"), (5, 8, "F", 400000.0, "2024-01-01", "1-URGENT")]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                         "o_orderdate string, o_orderpriority string")
    orders.write.parquet(scratch + "/orders.parquet")
    got = QUERIES["union_all_filter"](spark, scratch)
    assert got.columns == orders.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, orders.where("o_orderkey <= 2").collect() * 2))
