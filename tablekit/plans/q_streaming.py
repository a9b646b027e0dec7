"""Streaming and ingest queries. Inputs are the driver's ``events`` rows,
written by Spark as files into a fresh folder under the shared scratch
location; the streams process them with ``availableNow`` and the result is
read back as a batch table, so each query checks against plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.plans.registry import register
from tablekit.session import shared_dir
from tablekit.sources import table
from tablekit.streaming import ingest, rescue
from tablekit.streaming import streams as ST

WINDOW = "10 seconds"
TUMBLING_SQL = """
    SELECT event_type, time_bucket(INTERVAL '10 seconds', ts) AS window_start,
           time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
           COUNT(*) AS n
    FROM events GROUP BY ALL"""
A_TYPES = ("click", "view", "error")
# JSON keeps microseconds only with an explicit pattern (default is millis)
TS_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _events_files(spark, d, where=None, fmt="parquet", path=None):
    ev = table(spark, d, "events")
    if where is not None:
        ev = ev.where(where)
    path = path or shared_dir(spark, "landing", "events", unique=True)
    w = ev.write.mode("append").format(fmt)      # one file per input split, no shuffle
    if fmt == "json":
        w = w.options(**TS_MICROS)
    w.save(path)
    return path, table(spark, d, "events").schema


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("tumbling_counts", ids=("STR7", "FN16"), sql=TUMBLING_SQL)
def tumbling_counts(spark, d):
    # batch form of the stream reader's windowed count
    return ST.window_counts(table(spark, d, "events"), "event_type", "ts", WINDOW)


@register("stream_tumbling_counts", ids=("STR1", "STR7", "STR4", "STR3"), sql=TUMBLING_SQL)
def stream_tumbling_counts(spark, d):
    src, schema = _events_files(spark, d)
    stream = ST.as_event_time(ingest.stream_files(spark, "parquet", src, schema), "ts")
    agg = ST.window_counts(stream, "event_type", "ts", WINDOW)
    out = shared_dir(spark, "results", "tumbling", unique=True)
    q = ST.write_result(agg, out, out + "_ckpt", mode="complete")
    q.awaitTermination()
    return _ntz(ST.read_result(spark, out), "window_start", "window_end")


@register("stream_live_counts", ids=("STR8",), sql="""
    SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type""")
def stream_live_counts(spark, d):
    src, schema = _events_files(spark, d)
    agg = ST.live_counts(ingest.stream_files(spark, "parquet", src, schema), "event_type")
    out = shared_dir(spark, "results", "live", unique=True)
    ST.write_result(agg, out, out + "_ckpt").awaitTermination()
    return ST.read_result(spark, out).orderBy("event_type")


@register("stream_total", ids=("STR9",), sql="SELECT COUNT(*) AS record_count FROM events")
def stream_total(spark, d):
    src, schema = _events_files(spark, d)
    agg = ST.live_total(ingest.stream_files(spark, "parquet", src, schema))
    out = shared_dir(spark, "results", "total", unique=True)
    ST.write_result(agg, out, out + "_ckpt").awaitTermination()
    return ST.read_result(spark, out)


@register("copy_into_twice", ids=("STR5", "SRC6"), sql="SELECT * FROM events")
def copy_into_twice(spark, d):
    src, schema = _events_files(spark, d, fmt="json")
    target = shared_dir(spark, "tables", "events_copy", unique=True)
    first = ingest.copy_into(spark, target, src, "json", schema=schema, **TS_MICROS)
    second = ingest.copy_into(spark, target, src, "json", schema=schema, **TS_MICROS)
    if second != 0:
        raise AssertionError(f"COPY INTO loaded {second} rows again (first run {first})")
    return spark.read.parquet(target)


@register("ingest_run_once", ids=("STR1", "STR2", "STR3", "STR4"), sql="SELECT * FROM events")
def ingest_run_once(spark, d):
    # files arrive in two drops; each run_once loads only what is new, with a
    # schema inferred once and remembered outside the input folder
    in_a = F.col("event_type").isin(*A_TYPES)
    src, _ = _events_files(spark, d, fmt="json", where=in_a)
    target = shared_dir(spark, "tables", "events_ingest", unique=True)
    schema_loc = target + "_schema"
    ck = target + "_ckpt"
    stream = ingest.stream_files(spark, "json", src, schema_location=schema_loc)
    ingest.run_once(stream, target, ck)
    _events_files(spark, d, fmt="json", where=~in_a, path=src)
    stream = ingest.stream_files(spark, "json", src, schema_location=schema_loc)
    ingest.run_once(stream, target, ck)
    got = spark.read.parquet(target)
    # inferred JSON types: ts is a string, ints are long; cast back to the table's types
    return got.select(F.col("event_id").cast("long"), F.col("ts").cast("timestamp_ntz"),
                      F.col("user_id").cast("long"), "event_type", F.col("value").cast("double"),
                      "props")


RATED_SQL = """(SELECT event_id, CASE WHEN event_type IN {types} THEN 'A' ELSE 'B' END AS origin,
    CASE WHEN value IS NULL THEN 'none' WHEN value < 10 THEN 'small' WHEN value < 100 THEN 'medium' ELSE 'large' END
      AS size, CAST(ROUND(value * 100) AS BIGINT) AS weight, event_id % 7 AS bucket, ts FROM events)""".format(
    types=A_TYPES)


def _two_writers(spark, d):
    in_a = F.col("event_type").isin(*A_TYPES)
    (src_a, schema), (src_b, _) = (_events_files(spark, d, where=w) for w in (in_a, ~in_a))
    streams = {k: ST.rated_events(ingest.stream_files(spark, "parquet", src, schema), k)
               for k, src in (("A", src_a), ("B", src_b))}
    return streams, shared_dir(spark, "tables", "rated", unique=True)


@register("multi_writer_counts", ids=("STR10", "STR6"), sql=f"""
    SELECT origin, size, bucket, COUNT(*) AS n, COUNT(DISTINCT event_id) AS n_events, SUM(weight) AS weight
    FROM {RATED_SQL} r GROUP BY ALL""")
def multi_writer_counts(spark, d):
    streams, target = _two_writers(spark, d)
    for q in ST.multi_writer(streams, target, target + "_ckpt"):
        q.awaitTermination()
    t = ST.read_writers(spark, target, ("A", "B"))   # what both writers committed
    return t.groupBy("origin", "size", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_events"),
        F.sum("weight").cast("decimal(38,0)").cast("long").alias("weight"))


@register("batch_between_streams", ids=("STR11",), sql=f"""
    SELECT 'after A' AS seen, COUNT(*) FILTER (WHERE origin = 'A') AS n FROM {RATED_SQL} r
    UNION ALL SELECT 'after both', COUNT(*) FROM {RATED_SQL} r""")
def batch_between_streams(spark, d):
    # a batch query while a second writer is still to come: it sees exactly the
    # batches that were committed when it was planned
    streams, target = _two_writers(spark, d)
    seen = []
    for name, label in (("A", "after A"), ("B", "after both")):
        for q in ST.multi_writer({name: streams[name]}, target, target + "_ckpt"):
            q.awaitTermination()
        seen.append(ST.read_writers(spark, target, ("A", "B")[:len(seen) + 1]).agg(F.lit(label).alias("seen"), F.count(F.lit(1)).alias("n")))
    return seen[0].unionByName(seen[1])


@register("table_as_stream", ids=("STR12", "STR7", "STR8"), sql="""
    SELECT event_type, time_bucket(INTERVAL '10 seconds', ts) AS window_start, COUNT(*) AS n
    FROM events GROUP BY ALL""")
def table_as_stream(spark, d):
    # a stream writes a table; a second stream reads that table and counts by type and window
    src, schema = _events_files(spark, d)
    mid = shared_dir(spark, "tables", "events_table", unique=True)
    ingest.run_once(ingest.stream_files(spark, "parquet", src, schema), mid, mid + "_ckpt")
    stream = ST.as_event_time(ST.read_table_stream(spark, mid, schema), "ts")
    out = shared_dir(spark, "results", "from_table", unique=True)
    ST.write_result(ST.window_counts(stream, "event_type", "ts", WINDOW), out, out + "_ckpt").awaitTermination()
    return _ntz(ST.read_result(spark, out), "window_start").drop("window_end")


@register("batch_during_streams", ids=("STR10", "STR11"), sql=f"""
    SELECT origin, COUNT(*) AS n, SUM(weight) AS weight, true AS streams_ran, true AS seen_between
    FROM {RATED_SQL} r GROUP BY origin""")
def batch_during_streams(spark, d):
    # two writers keep running; a batch query reads their table while more files arrive
    in_a, early = F.col("event_type").isin(*A_TYPES), F.col("event_id") % 2 == 0
    src, streams = {}, {}
    for name, mine in (("A", in_a), ("B", ~in_a)):
        src[name], schema = _events_files(spark, d, where=mine & early)
        streams[name] = ST.rated_events(ingest.stream_files(spark, "parquet", src[name], schema), name)
    target = shared_dir(spark, "tables", "rated_live", unique=True)
    final = ST.rated_events(table(spark, d, "events"), "").schema

    def rows():
        return ST.read_writers(spark, target, ("A", "B"), final).count()

    qs = ST.multi_writer(streams, target, target + "_ckpt", available_now=False, processing_time="1 second")
    try:
        for q in qs:
            q.processAllAvailable()
        committed = rows()
        for name, mine in (("A", in_a), ("B", ~in_a)):
            _events_files(spark, d, where=mine & ~early, path=src[name])
        during = rows()                              # whatever is committed by now
        ran = all(q.isActive for q in qs)
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    t = ST.read_writers(spark, target, ("A", "B"), final)
    between = committed <= during <= t.count()
    return t.groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").cast("decimal(38,0)").cast("long").alias("weight")).select(
        "origin", "n", "weight", F.lit(ran).alias("streams_ran"), F.lit(between).alias("seen_between"))


@register("stream_windows_merged", ids=("STR7", "STR1"), sql=TUMBLING_SQL)
def stream_windows_merged(spark, d):
    # four drops, each with rows of all times: from the second on, all rows are late
    src = shared_dir(spark, "landing", "late", unique=True)
    for n in range(4):
        _events_files(spark, d, where=F.col("event_id") % 4 == n, path=src)
    schema = table(spark, d, "events").schema
    stream = ST.as_event_time(ingest.stream_files(spark, "parquet", src, schema, max_files_per_trigger=1), "ts")
    out = shared_dir(spark, "results", "merged", unique=True)
    ST.merge_window_counts(stream, out, out + "_ckpt", "event_type", "ts", WINDOW).awaitTermination()
    return _ntz(ST.read_window_counts(stream, out, "event_type"), "window_start", "window_end")


@register("stream_on_timer", ids=("STR13", "STR6"), sql=f"""
    SELECT size, COUNT(*) AS n, COUNT(DISTINCT event_id) AS n_events, true AS several_batches
    FROM {RATED_SQL} r GROUP BY size""")
def stream_on_timer(spark, d):
    src = shared_dir(spark, "landing", "timed", unique=True)
    for n in range(3):
        _events_files(spark, d, where=F.col("event_id") % 3 == n, path=src)
    schema = table(spark, d, "events").schema
    stream = ST.rated_events(ingest.stream_files(spark, "parquet", src, schema, max_files_per_trigger=1), "T")
    target = shared_dir(spark, "tables", "timed", unique=True)
    batches = ST.run_on_timer(lambda: ingest.start(stream, target, target + "_ckpt", processing_time="1 second"))
    return spark.read.parquet(target).groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_events")).withColumn(
        "several_batches", F.lit(batches > 1))


def _move_in(spark, folder, path, days_old):
    """Moves the files of ``folder`` into ``path``, dated back."""
    jvm = spark.sparkContext._jvm
    here, there = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(here):
        if st.getPath().getName().startswith("part-"):
            fs.setTimes(st.getPath(), st.getModificationTime() - days_old * 86_400_000, -1)
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(there, st.getPath().getName()))


@register("ingest_rescued", ids=("STR2", "STR1", "STR3"), sql=f"""
    SELECT event_id, ts, user_id, event_type, value, props,
           CASE WHEN event_type IN {A_TYPES} THEN NULL ELSE event_id % 3 END AS shift,
           event_type NOT IN {A_TYPES} AND value IS NOT NULL AS was_rescued FROM events""")
def ingest_rescued(spark, d):
    # files that arrive while the stream runs, dated a month back, in which `value`
    # has become text and `shift` is new; no value of them is lost
    in_a = F.col("event_type").isin(*A_TYPES)
    src, _ = _events_files(spark, d, fmt="json", where=in_a)
    target = shared_dir(spark, "tables", "events_rescued", unique=True)
    loc = target + "_schema"
    q = ingest.start(ingest.stream_json(spark, src, schema_location=loc), target, target + "_ckpt",
                     processing_time="1 second")
    try:
        q.processAllAvailable()
        later = table(spark, d, "events").where(~in_a).withColumns({
            "value": F.concat(F.col("value").cast("string"), F.lit(" units")), "shift": F.col("event_id") % 3})
        side = shared_dir(spark, "landing", "side", unique=True)
        later.write.options(**TS_MICROS).json(side)
        _move_in(spark, side, src, 30)
        q.processAllAvailable()
    finally:
        q.stop()
    rescue.learn(spark, target, loc)
    t = rescue.read_rescued(spark, target, loc)
    text = F.col("rescued")["value"]
    return t.select(F.col("event_id").cast("long"), F.col("ts").cast("timestamp_ntz"), F.col("user_id").cast("long"),
                    "event_type", F.coalesce("value", F.regexp_replace(text, " units$", "").cast("double")).alias("value"),
                    "props", F.col("shift").cast("long"), text.isNotNull().alias("was_rescued"))
