"""A DataFrame query and its SQL spelling give the same rows, on the driver's tables."""

import pytest
from pyspark.sql import functions as F

from tablekit.operators import relational as R
from tests.conftest import SF_SMALL

SUPPLIERS = ("s_nationkey < 12", "s_acctbal > 1500")


@pytest.fixture()
def tables(spark):
    out = {}
    for name in ("supplier", "nation", "lineitem"):
        out[name] = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        out[name].createOrReplaceTempView(f"sp_{name}")
    return out


def same(a, b):
    assert a.columns == b.columns
    x, y = (sorted(map(str, df.collect())) for df in (a, b))
    assert x == y and x
    return len(x)


def test_union_keeps_repeated_rows(spark, tables):
    s = tables["supplier"]
    some = s.where(" AND ".join(SUPPLIERS))
    n = same(s.union(some).where(SUPPLIERS[1]),
             spark.sql(f"SELECT * FROM (SELECT * FROM sp_supplier UNION ALL SELECT * FROM sp_supplier "
                       f"WHERE {SUPPLIERS[0]} AND {SUPPLIERS[1]}) WHERE {SUPPLIERS[1]}"))
    assert n == s.where(SUPPLIERS[1]).count() + some.count()


def test_join_and_case(spark, tables):
    a = (tables["supplier"].join(tables["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
         .select("s_suppkey", "n_name", F.when(F.col("s_acctbal") < 0, "owes").otherwise("owed").alias("side")))
    same(a, spark.sql("SELECT s_suppkey, n_name, CASE WHEN s_acctbal < 0 THEN 'owes' ELSE 'owed' END AS side "
                      "FROM sp_supplier JOIN sp_nation ON n_nationkey = s_nationkey"))


def test_pivot_with_a_decimal_average(spark, tables):
    li = tables["lineitem"].withColumn("qty", F.col("l_quantity").cast("int"))
    a = R.pivot(li, ["l_returnflag"], "l_linestatus", {"F": "F", "O": "O"},
                {"mean": lambda c: F.avg(c).cast("decimal(4,2)"), "most": F.max}, value_col="qty").orderBy("l_returnflag")
    b = spark.sql("""SELECT * FROM (SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INT) AS qty FROM sp_lineitem)
                     PIVOT (CAST(AVG(qty) AS DECIMAL(4, 2)) AS mean, MAX(qty) AS most
                            FOR l_linestatus IN ('F' AS F, 'O' AS O)) ORDER BY l_returnflag""")
    assert sorted(a.columns) == sorted(b.columns)
    assert [r.asDict() for r in a.collect()] == [r.asDict() for r in b.select(a.columns).collect()]


def test_ranks_with_ties(spark, tables):
    per = tables["lineitem"].groupBy("l_returnflag", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    a = R.top_n_per_group(per, ["l_returnflag"], [F.desc("n")], 2)
    b = spark.sql("""SELECT * FROM (SELECT l_returnflag, l_linenumber, n,
                       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY n DESC) AS rank
                     FROM (SELECT l_returnflag, l_linenumber, COUNT(*) AS n FROM sp_lineitem GROUP BY ALL))
                     WHERE rank <= 2""")
    same(a, b.select(a.columns))
