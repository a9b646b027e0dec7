"""Incremental file ingest on the file stream source.

Exactly-once bookkeeping is Spark's: the source records which files each
micro-batch read in the checkpoint, the Parquet sink commits through its
``_spark_metadata`` log. A file is known by its path, so the same content
under a new name is loaded again, and a re-run loads nothing twice.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablekit.streaming import rescue


class NewFields(ValueError):
    """Files that arrived since the schema was remembered have fields it lacks."""


def _infer(spark: SparkSession, fmt: str, path: str, read_options) -> StructType:
    """Schema of all files in ``path`` (of Parquet and ORC the footers, of each file)."""
    merge = {"mergeSchema": "true"} if fmt in ("parquet", "orc") else {}
    return spark.read.format(fmt).options(**{**merge, **read_options}).load(path).schema


def remember_schema(spark: SparkSession, fmt: str, path: str, schema_location: str,
                    refresh: bool = False, **read_options) -> StructType:
    """The input's schema, inferred at first and kept at ``schema_location``
    (outside the input directory). Later calls look at all files again, however
    they are dated (JSON streams need no such call, see :func:`stream_json`). A
    field that the remembered schema lacks, or another type of a known field,
    fails with :class:`NewFields`; ``refresh=True`` adds new fields."""
    old = rescue.load_schema(spark, schema_location)
    inferred = _infer(spark, fmt, path, read_options)
    if old is None:
        merged = inferred
    else:
        have = {f.name: f.dataType for f in old.fields}
        new = [f for f in inferred.fields if f.name not in have]
        other = [f.name for f in inferred.fields if f.name in have and f.dataType != have[f.name]]
        if other:
            raise NewFields(f"fields {other} in {path} have other types than the remembered schema; "
                            "load them with stream_json, which keeps such values")
        if new and not refresh:
            raise NewFields(f"new fields {[f.name for f in new]} in {path}; refresh the schema to load them")
        merged = StructType(list(old.fields) + new)
    rescue.store_schema(spark, schema_location, merged, checked=time.time())
    return merged


def stream_json(spark: SparkSession, path: str, schema: StructType | None = None, schema_location: str | None = None,
                on_new: str = "rescue", max_files_per_trigger: int | None = None, max_file_age: str = "3650d",
                **options) -> DataFrame:
    """A streaming DataFrame over the JSON lines that arrive in ``path``, without
    losing what the schema does not hold (:mod:`tablekit.streaming.rescue`).
    ``on_new``: "rescue" keeps it in a ``rescued`` column, "fail" ends the stream.
    A schema that is not given is inferred once and remembered. Files dated
    further back than ``max_file_age`` before the newest one would be passed over
    by the file source; the price of a long age is that the paths of all files
    of that time stay in the driver's memory."""
    if on_new not in ("rescue", "fail"):
        raise ValueError(f"on_new: rescue or fail, not {on_new}")
    if schema is None:
        if schema_location is None:
            raise ValueError("stream_json needs a schema or a schema_location to remember one")
        schema = rescue.load_schema(spark, schema_location)
        if schema is None:
            schema = spark.read.options(**options).json(path).schema
            rescue.store_schema(spark, schema_location, schema, checked=time.time())
    r = spark.readStream.option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = rescue.parse_rescuing(r.text(path), schema, **options)
    return rescue.refusing(rows) if on_new == "fail" else rows


def stream_files(spark: SparkSession, fmt: str, path: str, schema: StructType | str | None = None,
                 schema_location: str | None = None, max_files_per_trigger: int | None = None,
                 **options) -> DataFrame:
    """A streaming DataFrame over the files arriving in ``path``. Under a
    remembered schema nothing is dropped in silence: a row of JSON with a field
    or type that the schema does not hold ends the stream, whenever its file
    arrives; files of other formats are compared by their own schema at the start."""
    if schema is None:
        if schema_location is None:
            raise ValueError("stream_files needs a schema or a schema_location to remember one")
        schema = remember_schema(spark, fmt, path, schema_location)
        if fmt == "json":
            return stream_json(spark, path, schema, on_new="fail", max_files_per_trigger=max_files_per_trigger, **options)
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def start(stream: DataFrame, target: str | None, checkpoint: str, fmt: str = "parquet",
          available_now: bool = False, processing_time: str | None = None,
          partition_by: list[str] | None = None, name: str | None = None,
          table: str | None = None) -> StreamingQuery:
    """Stream into a file table with a checkpoint (append, exactly once).
    With ``table`` the sink is that catalog table (``toTable``) instead of a
    path."""
    w = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.toTable(table) if table else w.start(target)


def _rows_in(spark: SparkSession, target: str | None, table: str | None) -> int:
    """Rows committed to the sink so far (answered from Parquet footers)."""
    if table:
        return spark.table(table).count() if spark.catalog.tableExists(table) else 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.rstrip("/") + "/_spark_metadata")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.parquet(target).count() if there else 0


def run_once(stream: DataFrame, target: str | None, checkpoint: str, **kw) -> int:
    """Process every file not seen before, then stop (``trigger(once)`` in
    its modern form). Returns the number of rows this run added to the sink,
    over all its micro-batches."""
    spark = stream.sparkSession
    before = _rows_in(spark, target, kw.get("table"))
    q = start(stream, target, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _rows_in(spark, target, kw.get("table")) - before


def copy_into(spark: SparkSession, target: str, source: str, fmt: str,
              schema: StructType | str | None = None, schema_location: str | None = None,
              checkpoint: str | None = None, **options) -> int:
    """``COPY INTO target FROM source FILEFORMAT = fmt``: idempotent batch
    load of a directory. The checkpoint lives beside the data (``_``-prefixed,
    so readers of ``target`` skip it); a second call loads only new files."""
    ck = checkpoint or target.rstrip("/") + "/_copy_into_checkpoint"
    if schema is None and schema_location is None:
        schema_location = target.rstrip("/") + "/_copy_into_schema"
    s = stream_files(spark, fmt, source, schema, schema_location, **options)
    return run_once(s, target, ck)
