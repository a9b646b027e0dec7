"""Ingest and streaming tests in fresh folders with availableNow."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.streaming import ingest, rescue
from tablekit.streaming import streams as ST

IOT_SCHEMA = "device_id long, reading double, ts timestamp"


def drop_file(spark, folder, name, rows):
    """Write one JSON-lines file named ``name`` (test helper)."""
    path = f"{folder}/{name}"
    import os
    os.makedirs(folder.replace("file:", ""), exist_ok=True)
    with open(path.replace("file:", ""), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return path


def test_copy_into_is_idempotent_by_path(spark, scratch):
    src, target = scratch + "/in", scratch + "/iot"
    rows = [{"device_id": i, "reading": i * 1.5, "ts": "2021-01-01T00:00:0%d" % i} for i in range(3)]
    drop_file(spark, src, "f1.json", rows)
    assert ingest.copy_into(spark, target, src, "json", schema=IOT_SCHEMA) == 3
    assert ingest.copy_into(spark, target, src, "json", schema=IOT_SCHEMA) == 0
    drop_file(spark, src, "f1_copy.json", rows)          # same content, new name
    assert ingest.copy_into(spark, target, src, "json", schema=IOT_SCHEMA) == 3
    assert spark.read.parquet(target).count() == 6


def test_row_count_covers_all_micro_batches(spark, scratch):
    src, target = scratch + "/in_many", scratch + "/many"
    for i in range(125):
        drop_file(spark, src, f"f{i}.json", [{"device_id": i, "reading": 1.0}])
    s = ingest.stream_files(spark, "json", src, IOT_SCHEMA, max_files_per_trigger=1)
    assert ingest.run_once(s, target, scratch + "/ck_many") == 125
    assert spark.read.parquet(target).count() == 125


def test_run_once_remembers_schema_and_restarts(spark, scratch):
    src, target = scratch + "/in", scratch + "/t"
    loc, ck = scratch + "/schema", scratch + "/ck"
    drop_file(spark, src, "a.json", [{"device_id": 1, "reading": 2.0}])
    s = ingest.stream_files(spark, "json", src, schema_location=loc)
    assert ingest.run_once(s, target, ck) == 1
    assert ingest.remember_schema(spark, "json", src, loc).fieldNames() == ["device_id", "reading"]
    # a file with a new field is never loaded without it
    drop_file(spark, src, "b.json", [{"device_id": 2, "reading": 3.0, "extra": "x"}])
    with pytest.raises(ingest.NewFields, match="extra"):
        ingest.stream_files(spark, "json", src, schema_location=loc)
    # refreshed, the field is loaded
    assert "extra" in ingest.remember_schema(spark, "json", src, loc, refresh=True).fieldNames()
    s = ingest.stream_files(spark, "json", src, schema_location=loc)
    assert ingest.run_once(s, target, ck) == 1
    # restart from the checkpoint: nothing new -> nothing loaded
    s = ingest.stream_files(spark, "json", src, schema_location=loc)
    assert ingest.run_once(s, target, ck) == 0
    got = spark.read.option("mergeSchema", "true").parquet(target)
    assert sorted((r["device_id"], r["extra"]) for r in got.collect()) == [(1, None), (2, "x")]


def test_window_counts_stream_equals_batch(spark, scratch):
    rows = [(f"2021-01-01 00:00:{s:02d}", t) for s in range(0, 40, 3) for t in ("a", "b")]
    df = spark.createDataFrame(rows, "ts string, type string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    src = scratch + "/src"
    df.repartition(3).write.parquet(src)
    batch = ST.window_counts(df, "type", "ts", "10 seconds")
    stream = ingest.stream_files(spark, "parquet", src, df.schema, max_files_per_trigger=1)
    out = scratch + "/out"
    ST.write_result(ST.window_counts(stream, "type", "ts", "10 seconds"), out,
                    scratch + "/ck").awaitTermination()
    assert sorted(map(tuple, ST.read_result(spark, out).collect()), key=str) == \
        sorted(map(tuple, batch.collect()), key=str)
    assert batch.count() == 8
    # one file per trigger -> three results, dropped only on request
    assert len(ST._committed(spark, out)) == 3
    assert ST.drop_results(spark, out, keep=1) == 2
    assert ST.read_result(spark, out).count() == 8


def test_a_new_checkpoint_gives_the_newest_result(spark, scratch):
    src, out = scratch + "/src_new", scratch + "/out_new"
    spark.range(30).selectExpr("id % 3 AS type").repartition(3).write.parquet(src)

    def run(checkpoint, **kw):
        s = ingest.stream_files(spark, "parquet", src, "type long", **kw)
        ST.write_result(ST.live_counts(s, "type"), out, checkpoint).awaitTermination()
        return sorted(map(tuple, ST.read_result(spark, out).collect()))

    assert run(scratch + "/ck1", max_files_per_trigger=1) == [(0, 10), (1, 10), (2, 10)]   # batches 0, 1, 2
    spark.range(3).selectExpr("id AS type").write.mode("append").parquet(src)
    assert run(scratch + "/ck2") == [(0, 11), (1, 11), (2, 11)]                            # batch 0 again


def test_readers_see_committed_batches_only(spark, scratch):
    target = scratch + "/writers"
    assert ST.read_writers(spark, target, ("A", "B"), "id long").count() == 0
    with pytest.raises(FileNotFoundError):
        ST.read_writers(spark, target, ("A",))
    spark.range(5).write.parquet(scratch + "/in_a")
    s = ingest.stream_files(spark, "parquet", scratch + "/in_a", "id long")
    for q in ST.multi_writer({"A": s}, target, scratch + "/ck_w"):
        q.awaitTermination()
    # files of a batch that never committed lie beside the log's
    spark.range(100).write.mode("append").parquet(target + "/writer=A/half")
    os.rename(glob.glob(f"{target}/writer=A/half/part-*".replace("file:", ""))[0],
              f"{target}/writer=A/part-lost.parquet".replace("file:", ""))
    assert ST.read_writers(spark, target, ("A", "B"), "id long").count() == 5
    # a writer that starts again from its checkpoint adds only what is new
    spark.range(5, 7).write.mode("append").parquet(scratch + "/in_a")
    for q in ST.multi_writer({"A": s}, target, scratch + "/ck_w"):
        q.awaitTermination()
    assert sorted(r.id for r in ST.read_writers(spark, target, ("A",)).collect()) == list(range(7))


def test_two_writers_on_a_timer_and_the_table_as_a_stream(spark, scratch):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")

    def arriving(name):
        ev.where(F.col("event_id") % 2 == int(name == "B")).repartition(3).write.parquet(f"{scratch}/{name}")
        s = ingest.stream_files(spark, "parquet", f"{scratch}/{name}", ev.schema, max_files_per_trigger=1)
        return ST.rated_events(s, name)

    target = scratch + "/rated"
    schema = ST.rated_events(ev, "").schema
    qs = ST.multi_writer({k: arriving(k) for k in "AB"}, target, scratch + "/ck",
                         available_now=False, processing_time="1 second")
    counts, deadline = [], time.time() + 60
    while time.time() < deadline and (not counts or counts[-1] < ev.count()):
        counts.append(ST.read_writers(spark, target, "AB", schema).count())
        time.sleep(0.2)
    assert counts == sorted(counts) and counts[-1] == ev.count()        # never more, never less than before
    assert len(ST.end_streams(spark, "writer_")) == 2 and not any(q.isActive for q in qs)
    got = ST.read_writers(spark, target, "AB")
    want = ST.rated_events(ev, "x").drop("origin")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    stream = ST.read_table_stream(spark, f"{target}/writer=A", got.schema)
    ST.write_result(ST.live_counts(stream, "size"), scratch + "/live", scratch + "/ck_live").awaitTermination()
    live = {r["size"]: r["n"] for r in ST.read_result(spark, scratch + "/live").collect()}
    assert live == {r["size"]: r["count"] for r in got.where("origin = 'A'").groupBy("size").count().collect()}


def timed_rows(spark, rows):
    return spark.createDataFrame(rows, "type string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))


def test_merged_windows_count_late_rows_and_touch_few_days(spark, scratch):
    src, out, ck = scratch + "/src_m", scratch + "/merged", scratch + "/ck_m"
    drops = [[("a", "2024-01-01 00:00:01"), ("a", "2024-01-02 00:00:01"), (None, "2024-01-02 00:00:02")],
             [("a", "2024-01-02 00:00:03"), ("b", "2024-01-03 00:00:01")],
             [("a", "2024-01-01 00:00:02")]]                              # two days late
    files = lambda: {os.path.basename(os.path.dirname(f)): f for f in glob.glob(f"{out}/day=*/part-*".replace("file:", ""))}
    seen = []
    for rows in drops:
        timed_rows(spark, rows).coalesce(1).write.mode("append").parquet(src)
        s = ingest.stream_files(spark, "parquet", src, "type string, ts timestamp")
        ST.merge_window_counts(s, out, ck, "type", "ts", "10 seconds").awaitTermination()
        seen.append(files())
    assert seen[0]["day=2024-01-01"] == seen[1]["day=2024-01-01"] != seen[2]["day=2024-01-01"]
    assert seen[1]["day=2024-01-02"] == seen[2]["day=2024-01-02"]
    want = ST.window_counts(timed_rows(spark, sum(drops, [])), "type", "ts", "10 seconds")
    assert sorted(map(str, ST.read_window_counts(s, out, "type").collect())) == sorted(map(str, want.collect()))
    assert ST.read_window_counts(s, scratch + "/none", "type").count() == 0


def test_a_repeated_batch_is_merged_once(spark, scratch):
    """The last batch's commit is taken away, as if the driver had died before it."""
    src, out, ck = scratch + "/src_r", scratch + "/merged_r", scratch + "/ck_r"
    for n, rows in enumerate([[("a", "2024-01-01 00:00:01")], [("a", "2024-01-01 00:00:02"), ("b", "2024-01-05 00:00:02")]]):
        timed_rows(spark, rows).coalesce(1).write.mode("append").parquet(src)
        s = ingest.stream_files(spark, "parquet", src, "type string, ts timestamp")
        ST.merge_window_counts(s, out, ck, "type", "ts", "10 seconds").awaitTermination()
    for f in glob.glob(f"{ck}/commits/*1*".replace("file:", "")) + glob.glob(f"{ck}/commits/.1*".replace("file:", "")):
        os.remove(f)
    ST.merge_window_counts(s, out, ck, "type", "ts", "10 seconds").awaitTermination()
    assert sorted((r.type, r.n) for r in ST.read_window_counts(s, out, "type").collect()) == [("a", 2), ("b", 1)]


def test_a_small_batch_is_merged_by_few_tasks(spark, scratch):
    """Whatever the number of shuffle partitions: what a batch keeps is not spread over all of them."""
    src, out = scratch + "/src_f", scratch + "/merged_f"
    timed_rows(spark, [("a", "2024-01-01 00:00:01"), ("b", "2024-01-02 00:00:01")]).coalesce(1).write.parquet(src)
    s = ingest.stream_files(spark, "parquet", src, "type string, ts timestamp")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        q = ST.merge_window_counts(s, out, scratch + "/ck_f", "type", "ts", "10 seconds")
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(str(q.runId)) for i in tracker.getJobInfo(j).stageIds]
    assert 0 < max(x.numCompletedTasks for x in stages if x) < 40
    assert sorted((r.type, r.n) for r in ST.read_window_counts(s, out, "type").collect()) == [("a", 1), ("b", 1)]


def test_results_are_found_by_their_pointer(spark, scratch):
    out = scratch + "/pointed"
    with pytest.raises(FileNotFoundError):
        ST.read_result(spark, out)
    spark.range(4).write.parquet(f"{out}/run=1/batch=0")
    ST._point(spark, out, "run=1/batch=0")
    spark.range(9).write.parquet(f"{out}/run=1/batch=1")                 # written, not yet named
    assert ST.read_result(spark, out).count() == 4
    ST._point(spark, out, "run=1/batch=1")
    assert ST.read_result(spark, out).count() == 9


def test_run_on_timer_drains_and_stops(spark, scratch):
    spark.range(30).repartition(3).write.parquet(scratch + "/in_t")
    s = ingest.stream_files(spark, "parquet", scratch + "/in_t", "id long", max_files_per_trigger=1)
    n = ST.run_on_timer(lambda: ingest.start(s, scratch + "/timed", scratch + "/ck_t", processing_time="1 second"))
    assert n == 3 and spark.read.parquet(scratch + "/timed").count() == 30
    assert not [q for q in spark.streams.active if q.isActive]


def test_a_line_is_parsed_twice_however_many_fields(spark):
    """Once for the typed columns, once for all its fields; filters and lambdas repeat neither."""
    lines = spark.createDataFrame([('{"a":1,"b":"x","c":2.5}',)], "value string")
    rows = rescue.parse_rescuing(lines, T.StructType().add("a", "long").add("b", "string").add("c", "double"))
    for df in (rows, rescue.refusing(rows), rows.where("rescued IS NULL AND a > 0").select("b")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 2
    assert [tuple(r) for r in rescue.refusing(rows).collect()] == [(1, "x", 2.5)]


def test_rescue_keeps_what_the_schema_does_not_hold(spark):
    schema = T.StructType().add("a", "long").add("b", "string").add("c", "double").add(
        "n", T.StructType().add("p", "long").add("q", "string"))
    cases = [('{"a":1,"b":"x","c":2.5,"n":{"p":1,"q":"z"}}', (1, "x", 2.5, (1, "z"), None)),
             ('{"a":"one","b":5,"c":"2.5 u","new":[1,2]}', (None, "5", None, None, {"a": "one", "c": "2.5 u", "new": "[1,2]"})),
             ('{"a":1.5,"b":null}', (None, None, None, None, {"a": "1.5"})),
             ('{"c":12345678901234567}', (None, None, 1.2345678901234568e16, None, {"c": "12345678901234567"})),
             ('{"n":{"p":"bad","q":"z","r":1}}', (None, None, None, (None, "z"), {"n": '{"p":"bad","q":"z","r":1}'})),
             ('not json', (None, None, None, None, {rescue.LINE: "not json"})),
             ('{"a":3,"b":', (None, None, None, None, {rescue.LINE: '{"a":3,"b":'})),
             ('[{"a":1}]', (None, None, None, None, {rescue.LINE: '[{"a":1}]'})),
             ('{"a":8} more', (8, None, None, None, {rescue.LINE: '{"a":8} more'})),
             ('{"a":8}{"a":9}', (8, None, None, None, {rescue.LINE: '{"a":8}{"a":9}'})),
             ('{"A":4}', (None, None, None, None, {"A": "4"}))]
    for line, want in cases:
        df = rescue.parse_rescuing(spark.createDataFrame([(line,), ("  ",)], "value string"), schema)
        got = df.collect()
        assert [tuple(r) for r in got] == [want], line
        if want[-1]:
            with pytest.raises(Exception, match="does not hold"):
                rescue.refusing(df).collect()


def test_json_stream_loses_nothing_that_changes_or_arrives_late(spark, scratch):
    src, target, loc = scratch + "/in_x", scratch + "/x", scratch + "/x_schema"
    drop_file(spark, src, "a.json", [{"k": 1, "v": 1.5}])
    q = ingest.start(ingest.stream_json(spark, src, schema_location=loc), target, scratch + "/ck_x", processing_time="1 second")
    q.processAllAvailable()
    drop_file(spark, scratch + "/side", "b.json", [{"k": 2, "v": "two"}, {"k": 3, "v": 3.5, "extra": 7}])
    old = f"{scratch}/side/b.json".replace("file:", "")
    os.utime(old, (time.time() - 40 * 86400,) * 2)                       # dated before all others
    os.rename(old, f"{src}/b.json".replace("file:", ""))
    q.processAllAvailable()
    q.stop()
    assert rescue.learn(spark, target, loc).simpleString() == "struct<k:bigint,v:double,extra:bigint>"
    got = sorted(tuple(r) for r in rescue.read_rescued(spark, target, loc).collect())
    assert got == [(1, 1.5, None, None), (2, None, None, {"v": "two"}), (3, 3.5, 7, None)]
    # from now on the field is a column; a type that does not fit still ends a strict stream
    drop_file(spark, src, "c.json", [{"k": 4, "extra": 8}])
    ingest.run_once(ingest.stream_json(spark, src, schema_location=loc), target, scratch + "/ck_x")
    assert {r.k: r.extra for r in rescue.read_rescued(spark, target, loc).collect()} == {1: None, 2: None, 3: 7, 4: 8}
    strict = ingest.stream_json(spark, src, schema_location=loc, on_new="fail")
    with pytest.raises(Exception, match="does not hold"):
        ingest.run_once(strict, scratch + "/strict", scratch + "/ck_s")


def test_a_file_that_arrives_mid_run_is_checked_as_well(spark, scratch):
    src = scratch + "/in_mid"
    drop_file(spark, src, "a.json", [{"k": 1}])
    s = ingest.stream_files(spark, "json", src, schema_location=scratch + "/mid_schema")
    q = ingest.start(s, scratch + "/mid", scratch + "/ck_mid", processing_time="1 second")
    q.processAllAvailable()
    drop_file(spark, src, "b.json", [{"k": "text"}])
    with pytest.raises(Exception, match="does not hold"):
        q.processAllAvailable()
    assert spark.read.parquet(scratch + "/mid").count() == 1


def test_other_types_of_known_fields_are_refused(spark, scratch):
    src, loc = scratch + "/in_ty", scratch + "/ty_schema"
    spark.range(3).write.parquet(src)
    assert ingest.remember_schema(spark, "parquet", src, loc).fieldNames() == ["id"]
    spark.range(2).selectExpr("cast(id AS string) AS id").write.parquet(scratch + "/other")
    with pytest.raises(ingest.NewFields, match="other types"):
        ingest.remember_schema(spark, "parquet", scratch + "/other", loc)


def test_stream_into_catalog_table(spark, scratch):
    src = scratch + "/src"
    spark.range(20).withColumnRenamed("id", "k").write.parquet(src)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tk_stream LOCATION '{scratch}/wh'")
    s = ingest.stream_files(spark, "parquet", src, "k long")
    q = ingest.start(s, None, scratch + "/ck", available_now=True, table="tk_stream.ks")
    q.awaitTermination()
    assert spark.table("tk_stream.ks").count() == 20
