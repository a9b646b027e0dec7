"""Readers and writers on small inline fixtures shaped like the reference's
inputs (fire calls CSV with explicit schema, departure delays as strings,
tab-separated airports, a JDBC table)."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import scalar as S
from tablekit.sources import empty_like, query_path, read_csv, read_jdbc, write_jdbc

FIRE_SCHEMA = T.StructType([
    T.StructField("CallNumber", T.IntegerType()), T.StructField("CallType", T.StringType()),
    T.StructField("CallDate", T.StringType()), T.StructField("AvailableDtTm", T.StringType()),
    T.StructField("Zipcode", T.IntegerType()), T.StructField("Delay", T.FloatType()),
])


def write_text(scratch, name, text):
    d = scratch.replace("file:", "") + "/" + name
    os.makedirs(d, exist_ok=True)
    with open(d + "/part-0.csv", "w") as f:
        f.write(text)
    return scratch + "/" + name


def test_fire_calls_explicit_schema(spark, scratch):
    p = write_text(scratch, "fire", "CallNumber,CallType,CallDate,AvailableDtTm,Zipcode,Delay\n"
                   "1,Medical Incident,01/11/2002,01/11/2002 01:51:44 AM,94102,2.5\n"
                   "2,,02/30/2002,01/11/2002 03:01:18 PM,94103,7.25\n"
                   "3,Alarms,12/31/2018,12/31/2018 11:59:59 PM,94102,5.5\n")
    df = read_csv(spark, p, schema=FIRE_SCHEMA)
    df = df.withColumn("IncidentDate", S.parse_ts("CallDate", "MM/dd/yyyy")) \
        .withColumn("AvailableTs", S.parse_ts("AvailableDtTm", "MM/dd/yyyy hh:mm:ss a"))
    got = {r["CallNumber"]: r for r in df.collect()}
    assert got[2]["IncidentDate"] is None                 # bad date -> NULL
    assert got[2]["AvailableTs"].hour == 15
    assert df.where(F.col("CallType").isNotNull()).select("CallType").distinct().count() == 2
    assert df.where(F.col("Delay") > 5).count() == 2
    assert [r[0] for r in df.where(F.year("IncidentDate") == 2018).select("CallNumber").collect()] == [3]


def test_delays_all_strings_then_cast(spark, scratch):
    p = write_text(scratch, "delays", "date,delay,distance,origin,destination\n"
                   "01011245,6,602,ABE,ATL\n01010710,x,369,SEA,SFO\n01011100,-8,602,SEA,SFO\n")
    df = read_csv(spark, p, infer=False, casts={"delay": "int", "distance": "int"})
    assert dict(df.dtypes)["date"] == "string" and dict(df.dtypes)["delay"] == "int"
    got = {r["date"]: r["delay"] for r in df.collect()}
    assert got == {"01011245": 6, "01010710": None, "01011100": -8}
    assert df.where("date LIKE '01010%'").count() == 1


def test_tsv_inferred(spark, scratch):
    p = write_text(scratch, "airports", "City\tState\tIATA\nSeattle\tWA\tSEA\nNew York\tNY\tJFK\n")
    df = read_csv(spark, p, sep="\t")
    assert df.columns == ["City", "State", "IATA"] and df.count() == 2


def test_query_path_and_empty_like(spark, scratch):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    src.write.json(scratch + "/j")
    df = query_path(spark, "json", scratch + "/j", where="id > 1")
    assert [r["s"] for r in df.collect()] == ["b"]
    e = empty_like(df)
    assert e.count() == 0 and e.schema == df.schema
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan


def test_jdbc_partitioned_read(spark):
    url = "jdbc:derby:memory:tk_test_jdbc;create=true"
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    write_jdbc(nation, url, "NATION", driver="org.apache.derby.jdbc.EmbeddedDriver")
    df = read_jdbc(spark, url, "NATION", driver="org.apache.derby.jdbc.EmbeddedDriver",
                   partition_column="n_nationkey", lower=0, upper=25, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 25
    plain = read_jdbc(spark, url, "NATION", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert plain.rdd.getNumPartitions() == 1
    # the filter reaches the database
    plan = plain.where("N_REGIONKEY = 1").select("N_NAME")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "*EqualTo(n_regionkey,1)" in plan and "ReadSchema: struct<n_name:string>" in plan


def test_bucketed_tables_join_without_exchange(spark, scratch):
    from tablekit.sources import save_table
    sf = "/root/testdata/sf0.001"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tk_test LOCATION '{scratch}/wh'")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    save_table(o, "tk_test.orders_b", mode="overwrite", bucket_by=(8, ["o_orderkey"]))
    save_table(li, "tk_test.lineitem_b", mode="overwrite", bucket_by=(8, ["l_orderkey"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = spark.table("tk_test.orders_b"), spark.table("tk_test.lineitem_b")
        j = a.join(b, a.o_orderkey == b.l_orderkey).groupBy("o_orderstatus").count()
        plan = j._jdf.queryExecution().executedPlan().toString()
        join_part = plan.split("SortMergeJoin")[1]
        assert "Exchange hashpartitioning(o_orderkey" not in join_part
        assert "Exchange hashpartitioning(l_orderkey" not in join_part
        assert j.agg({"count": "sum"}).first()[0] == li.join(o, li.l_orderkey == o.o_orderkey).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
