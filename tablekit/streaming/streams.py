"""Stream transformations and stateful aggregates.

The aggregate builders take any DataFrame -- batch or streaming -- so the
same code is checked in batch against SQL and run incrementally on streams.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablekit.operators.partitioned import PartitionedTable



def rated_events(events: DataFrame, origin: str) -> DataFrame:
    """Event rows -> event_id, origin, size (by value), weight (whole hundredths),
    bucket and ts; a stateless projection, for a batch or a stream."""
    v = F.col("value")
    return events.select(
        "event_id", F.lit(origin).alias("origin"),
        F.when(v.isNull(), "none").when(v < 10, "small").when(v < 100, "medium").otherwise("large").alias("size"),
        F.round(v * 100).cast("long").alias("weight"), (F.col("event_id") % 7).alias("bucket"), "ts")


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    """Zone-less timestamps -> TIMESTAMP (session zone UTC) so watermarks work."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def window_counts(df: DataFrame, key: str, ts: str, duration: str,
                  watermark: str | None = None) -> DataFrame:
    """Count per (key, tumbling window). On a stream, ``watermark`` bounds the
    state: windows older than the watermark are finalised and dropped."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    return (df.groupBy(key, F.window(ts, duration))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(key, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "n"))


def live_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def live_total(df: DataFrame) -> DataFrame:
    return df.selectExpr("COUNT(*) AS record_count")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _run_name(checkpoint: str) -> str:
    """A checkpoint's own name: a stream that starts over from a new checkpoint
    counts its batches from 0 again and must not meet the old folders."""
    return f"{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"


def _committed(spark: SparkSession, target: str) -> list[tuple[int, int, str]]:
    """(time, batch id, path) of the batch folders under ``target`` whose write
    has committed, by time: for the clearing of old results, never for reads."""
    fs, path = _fs(spark, target)
    out, todo = [], [path] if fs.exists(path) else []
    while todo:
        for st in fs.listStatus(todo.pop()):
            p = st.getPath()
            name = p.getName()
            if not st.isDirectory():
                continue
            if name.startswith("batch="):
                done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
                if fs.exists(done):
                    out.append((fs.getFileStatus(done).getModificationTime(), int(name[6:]), p.toString()))
            elif name.startswith("run="):
                todo.append(p)
    return sorted(out)


def write_result(agg: DataFrame, target: str, checkpoint: str, mode: str = "complete",
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Keep the results of a stateful aggregate in ``target``.

    Each micro-batch writes its complete (key-bounded) result to its own
    ``run=<checkpoint>/batch=<id>`` folder; a replayed batch rewrites the same
    folder, and then becomes the result that the pointer file names. Readers
    (:func:`read_result`) follow the pointer, so they never see a half-written
    result and list nothing. Nothing is deleted under a reader;
    :func:`drop_results` clears old results when told to.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        folder = f"run={_run_name(checkpoint)}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(f"{target}/{folder}")
        _point(batch.sparkSession, target, folder)

    w = agg.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def _point(spark: SparkSession, target: str, folder: str) -> None:
    """Names ``folder`` as the newest result: a new file, moved over the old one."""
    jvm = spark.sparkContext._jvm
    fs, new = _fs(spark, f"{target}/_newest.{folder.replace('/', '_')}")
    out = fs.create(new, True)
    out.write(bytearray(folder.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{target}/_newest"), options)


def read_result(spark: SparkSession, target: str) -> DataFrame:
    """The newest committed result written by :func:`write_result`."""
    fs, pointer = _fs(spark, f"{target}/_newest")
    if not fs.exists(pointer):
        raise FileNotFoundError(f"no committed result under {target}")
    stream = fs.open(pointer)
    folder = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return spark.read.parquet(f"{target}/{folder}")


def drop_results(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Deletes all but the newest ``keep`` committed results."""
    old = _committed(spark, target)[:-keep]
    for _, _, path in old:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return len(old)


def multi_writer(streams: Mapping[str, DataFrame], target: str, checkpoint_base: str,
                 available_now: bool = True, processing_time: str | None = None
                 ) -> list[StreamingQuery]:
    """Several concurrent writers into one table. Two file sinks on one path
    would share a commit log and drop batches, so each writer is a file sink of
    its own under ``writer=<name>``, whose log commits each batch once."""
    qs = []
    for name, df in streams.items():
        checkpoint = f"{checkpoint_base}/{name}"
        w = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .outputMode("append").queryName(f"writer_{name}_{_run_name(checkpoint)}"))
        w = w.trigger(availableNow=True) if available_now else \
            w.trigger(processingTime=processing_time or "5 seconds")
        qs.append(w.start(f"{target}/writer={name}"))
    return qs


def read_writers(spark: SparkSession, target: str, writers: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """A batch read of what the named writers of :func:`multi_writer` have
    committed; safe while they write: Spark plans each part from the files in
    its sink's log, so a batch is seen whole or not at all. Without ``schema``
    every writer needs a committed batch."""
    parts = []
    for name in writers:
        fs, log = _fs(spark, f"{target}/writer={name}/_spark_metadata")
        # the log's folder is there before its first batch is
        if fs.exists(log) and any(st.getPath().getName().split(".")[0].isdigit() for st in fs.listStatus(log)):
            reader = spark.read if schema is None else spark.read.schema(schema)
            parts.append(reader.parquet(f"{target}/writer={name}"))
        elif schema is None:
            raise FileNotFoundError(f"writer {name} has committed nothing under {target}")
    if not parts:
        return spark.createDataFrame([], schema)
    return functools.reduce(DataFrame.unionByName, parts)


def merge_window_counts(stream: DataFrame, target: str, checkpoint: str, key: str, ts: str, duration: str,
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Counts per (key, tumbling window), added up in the table at ``target``.

    A micro-batch counts its own rows and adds them to the stored windows they
    fall into; only the days of those windows are written again. Spark keeps no
    window state, so nothing has to be evicted and a late row, however late, is
    counted into its window like any other. Each row names the batch that last
    changed it and its count before: a batch that is repeated after a failure
    starts from there, so it is counted once.
    """
    spark, run = stream.sparkSession, _run_name(checkpoint)
    table = PartitionedTable(spark, target, _merged_schema(stream, key), ("day",))
    cells = [key, "window_start", "window_end", "day"]

    def sink(batch: DataFrame, batch_id: int) -> None:
        name = f"{run}:{batch_id}"
        # kept before its shuffle: what is kept after one stays in all shuffle partitions, however few the rows
        rows = batch.select(key, ts).persist()
        try:
            days = rows.select(F.window(ts, duration)["start"].cast("date").alias("day")).distinct().collect()
            if not days:
                return
            counted = window_counts(rows, key, ts, duration).withColumn("day", F.col("window_start").cast("date"))
            none = F.lit(None)
            new = counted.select(*cells, F.col("n").alias("add"), none.cast("long").alias("n"),
                                 none.cast("long").alias("before"), none.cast("string").alias("batch"))
            fs, path = _fs(spark, target)
            if fs.exists(path):
                new = new.unionByName(table.read().where(table.within(days))
                                      .select(*cells, none.cast("long").alias("add"), "n", "before", "batch"))
            one = new.groupBy(*cells).agg(F.max("add").alias("add"), F.max("n").alias("n"),
                                          F.max("before").alias("before"), F.max("batch").alias("batch"))
            start = F.coalesce(F.when(F.col("batch") == name, F.col("before")).otherwise(F.col("n")), F.lit(0))
            touched = F.col("add").isNotNull()
            table.overwrite(one.select(
                *cells, F.when(touched, start + F.col("add")).otherwise(F.col("n")).alias("n"),
                F.when(touched, start).otherwise(F.col("before")).alias("before"),
                F.when(touched, F.lit(name)).otherwise(F.col("batch")).alias("batch")))
        finally:
            rows.unpersist()

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def _merged_schema(stream: DataFrame, key: str) -> StructType:
    return (StructType().add(key, stream.schema[key].dataType).add("window_start", "timestamp").add("window_end", "timestamp")
            .add("n", "long").add("before", "long").add("batch", "string").add("day", "date"))


def read_window_counts(stream: DataFrame, target: str, key: str) -> DataFrame:
    """What :func:`merge_window_counts` has stored (an empty result before its first batch)."""
    spark, schema = stream.sparkSession, _merged_schema(stream, key)
    fs, path = _fs(spark, target)
    df = spark.read.schema(schema).parquet(target) if fs.exists(path) else spark.createDataFrame([], schema)
    return df.select(key, "window_start", "window_end", "n")


def run_on_timer(start: Callable[[], StreamingQuery]) -> int:
    """Runs a query that was started with a periodic trigger until its input is
    drained, then stops it. Returns how many of its micro-batches had rows."""
    q = start()
    try:
        q.processAllAvailable()
        return sum(p["numInputRows"] > 0 for p in q.recentProgress)
    finally:
        q.stop()


def read_table_stream(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A Parquet table directory as a stream of its new files."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def end_streams(spark: SparkSession, prefix: str = "") -> list[str]:
    """Stops the active queries whose name starts with ``prefix``; their names."""
    ended = [q for q in spark.streams.active if (q.name or "").startswith(prefix)]
    for q in ended:
        q.stop()
    return [q.name or str(q.id) for q in ended]
