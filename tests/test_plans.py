"""Plan checks: pushdown, pruning, runtime join choice, window group limit,
skew-join split, JVM-side UDFs."""

import pytest

import __spark_entry__ as E
from tablekit.sources import items, skewed_sales

SF = "/root/testdata/sf0.01"
Q = E.queries()


def plan_after_run(df):
    """Run the DataFrame's own query execution, then read its final plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushdown_pruning_and_broadcast(spark):
    df = Q["flagship_join_sum"](spark, SF)
    static = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_retailprice), LessThan(p_retailprice,910.0)" in static
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in static
    assert "BroadcastHashJoin" in plan_after_run(df)


def test_aqe_switches_to_broadcast_when_filtered_side_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")   # static planner: no broadcast
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")  # runtime: allowed
    try:
        df = Q["flagship_join_sum"](spark, SF)
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        final = plan_after_run(df)
        assert "BroadcastHashJoin" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_top_n_uses_window_group_limit(spark):
    plan = Q["top3_lines_per_supplier"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_aqe_skew_join_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        s = skewed_sales(spark, 400000, 20000, seed=1)
        i = items(spark, 20000)
        df = s.join(i, s.s_item_id == i.i_item_id).groupBy("s_date").sum("s_quantity")
        final = plan_after_run(df)
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k in conf:
            spark.conf.unset(k)


@pytest.mark.parametrize("name,needle,absent", [
    ("udf_scalar_sql", None, "EvalPython"),
    ("udf_scalar_pandas", "ArrowEvalPython", "BatchEvalPython"),
    ("random_state", None, "EvalPython"),
])
def test_udf_paths(spark, name, needle, absent):
    plan = Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    if needle:
        assert needle in plan
    assert absent not in plan


def test_key_lookup_pushed(spark):
    plan = Q["key_lookup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,4420)" in plan


def test_scale_confs_sizes():
    from tablekit.session import scale_confs
    big = scale_confs(100 * (1 << 40), total_cores=8000)         # 100 TB, 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    small = scale_confs(20 << 20, total_cores=8)                  # sf0.1 locally
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20
    mid = scale_confs(1 << 40, total_cores=800)                   # 1 TB
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096


def test_aqe_coalesces_small_post_aggregation_shuffle(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = Q["daily_quantity"](spark, SF)
        final = plan_after_run(df)
        assert "AQEShuffleRead coalesced" in final
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_partition_filter_prunes_folders(spark):
    df = Q["partition_pruned_scan"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_year" in plan and "(ship_year#" in plan
    assert "= 1998)" in plan.split("PartitionFilters:")[1].split("]")[0]


@pytest.mark.parametrize("name", ["week_counts", "worst_group_avg"])
def test_year_filter_reaches_the_scan(spark, name):
    plan = Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_cached_result_is_scanned_twice_and_let_go(spark):
    from tablekit.plans.q_relational import cached_counts
    from tablekit.session import cached
    from tablekit.sources import table

    few = table(spark, SF, "lineitem").select("l_linenumber", "l_returnflag", "l_quantity")
    with cached(few) as kept:
        both = cached_counts(kept, "a", "l_linenumber").unionByName(cached_counts(kept, "b", "l_returnflag"))
        plan = plan_after_run(both)
        assert plan.count("InMemoryTableScan") >= 2
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    with pytest.raises(ZeroDivisionError):
        with cached(few) as kept:
            kept.count()
            1 / 0
    assert not few.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    Q["cached_reads"](spark, SF)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_sized_writes_rebalance_and_sizes_go_back(spark, scratch):
    from tablekit.session import input_bytes, sized_for
    from tablekit.sources import table, write_sized

    df = table(spark, SF, "lineitem").repartition(16)
    plan = df.hint("rebalance", "l_returnflag")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    write_sized(df, scratch + "/sized", ["l_returnflag"])
    df.write.partitionBy("l_returnflag").parquet(scratch + "/plain")
    count = {n: spark.read.parquet(f"{scratch}/{n}").select("_metadata.file_path").distinct().count() for n in ("sized", "plain")}
    assert count == {"sized": 3, "plain": 48}
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_for(spark, f"{SF}/lineitem.parquet", target_partition_bytes=1 << 10):
        assert int(spark.conf.get(key)) == -(-input_bytes(spark, f"{SF}/lineitem.parquet") // 1024)
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum") == str(spark.sparkContext.defaultParallelism)
        assert plan_after_run(df.groupBy("l_orderkey").count()).count("AQEShuffleRead") >= 1
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum", None) is None


def test_merge_checks_keys_without_a_window(spark):
    plan = Q["merge_upsert"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_exact_sums_hold_beyond_a_long(spark):
    from tablekit.functions.scalar import exact_sum, money_avg, money_sum

    big = spark.range(40).selectExpr("4611686018427387904 AS x", "cast(id AS double) / 8 AS m")
    assert big.agg(exact_sum("x")).first()[0] == float(40 * 2**62)
    assert big.agg(exact_sum("-x")).first()[0] == -float(40 * 2**62)
    r = big.agg(money_sum("m"), money_avg("m")).first()
    assert abs(r[0] - sum(round(i / 8 * 100 + 1e-9) for i in range(40)) / 100) < 1e-9 and abs(r[1] - r[0] / 40) < 1e-12
    assert tuple(big.where("m < 0").agg(money_sum("m"), money_avg("m")).first()) == (None, None)
