"""Hot keys and skew-safe joins on generated 80 %-skewed sales."""

from pyspark.sql import functions as F

from tablekit.operators import skew as SK
from tablekit.sources import items, skewed_sales


def test_generator_shape(spark):
    s = skewed_sales(spark, 20000, 1000, seed=3)
    hot = SK.hot_keys(s, "s_item_id", min_share=0.05).collect()
    assert len(hot) == 1 and hot[0]["key"] == 100 and 0.77 < hot[0]["share"] < 0.83
    assert s.agg(F.min("s_quantity"), F.max("s_quantity")).first() == (0, 99)


def test_salted_join_equals_plain_join(spark):
    s = skewed_sales(spark, 50000, 2000, seed=5).withColumn("row_id", F.monotonically_increasing_id())
    i = items(spark, 2000)
    salts = SK.hot_key_salts(s, "s_item_id", 0.05, rows_a_task=5000)
    assert salts == {100: -(-s.where("s_item_id = 100").count() // 5000)}
    plain = s.join(i, s.s_item_id == i.i_item_id)
    salted = SK.salted_join(s, i, "s_item_id", "i_item_id", salts, ["row_id"])
    cols = ["s_item_id", "s_quantity", "s_date", "i_item_id", "i_price"]
    assert sorted(map(tuple, plain.select(cols).collect())) == \
        sorted(map(tuple, salted.select(cols).collect()))
    left = SK.salted_join(s, i.where("i_item_id < 500"), "s_item_id", "i_item_id", salts, ["row_id"], how="left")
    assert left.count() == s.count()


def _rows_per_join_task(spark, joined):
    """Rows that each task of the shuffle join itself puts out."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        return [r["count"] for r in joined.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_identical_hot_rows_spread_over_the_join_tasks(spark):
    n = 40_000
    big = spark.range(n).select(F.when(F.col("id") % 5 > 0, 100).otherwise(F.col("id")).alias("k"), "id")
    small = spark.range(n).select(F.col("id").alias("k2"))
    salts = SK.hot_key_salts(big, "k", 0.05, rows_a_task=1000)
    assert salts == {100: 33} or salts == {100: 32}
    tasks = _rows_per_join_task(spark, SK.salted_join(big, small, "k", "k2", salts, ["id"]))
    assert sum(tasks) == n and max(tasks) < 8_000 and len(tasks) > 20
    one = _rows_per_join_task(spark, SK.salted_join(big, small, "k", "k2", {}, ["id"]))
    assert max(one) >= 32_000


def test_null_keys_spread_in_a_left_join(spark):
    n = 40_000
    big = spark.range(n).select(F.when(F.col("id") % 5 == 0, F.col("id")).alias("k"), "id")
    small = spark.range(n).select(F.col("id").alias("k2"))
    salts = SK.hot_key_salts(big, "k", 0.05, rows_a_task=1000)
    assert salts == {None: 32}
    joined = SK.salted_join(big, small, "k", "k2", salts, ["id"], how="left")
    tasks = _rows_per_join_task(spark, joined)
    assert sum(tasks) == n and max(tasks) < 8_000
    assert joined.where("k IS NULL AND k2 IS NULL").count() == 32_000


def test_salted_join_with_map_column(spark):
    big = spark.createDataFrame([(100, 1, {"a": 1}), (100, 2, {"b": 2}), (7, 3, {"c": 3})],
                                "k int, id int, m map<string,int>")
    small = spark.createDataFrame([(100, "hot"), (7, "cold")], "k2 int, label string")
    got = SK.salted_join(big, small, "k", "k2", {100: 4}, ["id"])
    assert sorted(r["label"] for r in got.collect()) == ["cold", "hot", "hot"]
