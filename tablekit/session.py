"""Session defaults and the shared scratch folder.

On a cluster the caller owns the SparkSession; ``tune`` only fills in what
is unset. ``local_session`` builds the small local session used by tests and
the bench.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable SQL confs we rely on. AQE re-plans joins from real sizes
# (sort-merge -> broadcast when a filtered side turns out small), coalesces
# the tiny post-aggregation shuffles and splits skewed join partitions.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows vary from bytes to megabytes: a batch for Python is bounded by size too
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}


def tune(spark: SparkSession, overwrite: bool = False) -> SparkSession:
    """Apply SQL_DEFAULTS to an existing session (only unset keys unless asked)."""
    for k, v in SQL_DEFAULTS.items():
        if overwrite or spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def scale_confs(input_bytes: int, total_cores: int, executor_mem_per_core: int = 4 << 30,
                target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizes for a job that reads ``input_bytes`` on ``total_cores`` cores.

    * shuffle partitions: enough that each holds ~``target_partition_bytes``
      of the input (an upper bound on what a shuffle carries), at least 2x the
      cores so every core has work. AQE then coalesces small ones and splits skewed ones at run time.
    * scan split: large files are read in splits that keep ~4 tasks per core
      per wave without going over ~1 GiB or below 128 MiB.
    * coalescing goes to full partitions of the advisory size, but never below
      a partition a core: few bytes may still be much work.
    * advisory size / skew threshold follow the partition target; the
      broadcast threshold stays a small slice of per-core memory, since every
      executor holds the whole broadcast side.
    * runtime Bloom filters: a filtered join side of up to 1 GiB (default
      10 MiB) may build a filter (up to 32 MiB) that prunes the big side
      before its shuffle, once that side's scan is over 10 GiB.
    """
    cores = max(1, int(total_cores))
    shuffle = max(2 * cores, -(-int(input_bytes) // target_partition_bytes))
    split = int(min(1 << 30, max(128 << 20, input_bytes // (4 * cores) if input_bytes else 0)))
    broadcast = int(min(256 << 20, max(10 << 20, executor_mem_per_core // 16)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 256 << 20)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(cores),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast),
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1 << 30),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(256 << 20),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under ``paths``, from the file system's own summary."""
    total = 0
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += fs.getContentSummary(path).getLength()
    return total


@contextlib.contextmanager
def sized_for(spark: SparkSession, *paths: str, **kw):
    """Within the block the session's sizes are those of :func:`scale_confs` for
    the bytes under ``paths``; afterwards they are what they were."""
    tune(spark)
    confs = scale_confs(input_bytes(spark, *paths), spark.sparkContext.defaultParallelism, **kw)
    before = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextlib.contextmanager
def cached(df: DataFrame):
    """``df`` kept by the executors (memory first, then their disk) within the
    block, for several reads of one result; let go at its end, also after an
    error. Write what is to outlive the block inside it."""
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist(blocking=True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tablekit", extra: dict | None = None) -> SparkSession:
    """Local session for tests / bench. UI off, event log off, UTC."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABLEKIT_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tk-wh-"))
        .config("spark.driver.extraJavaOptions",
                f"-Dderby.system.home={tempfile.mkdtemp(prefix='tk-derby-')}")
    )
    for k, v in SQL_DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablekit`` importable on the executors' Python workers
    (``--py-files`` at run time): the package is zipped once on the driver and
    added with ``addPyFile``, which Spark copies to every executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no context (e.g. a Connect session): nothing to ship
        return
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tk-pyfiles-"), "tablekit.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith((".py", ".txt")):            # code and its data files
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir). Only a local master may do without: a folder is made and
    registered then; on a cluster its executors would each write to a disk of
    their own, so that is an error. ``unique`` folders are scratch: they are
    removed when the application ends.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tk-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    if not unique:
        return "/".join([base.rstrip("/"), *parts])
    scratch = f"{base.rstrip('/')}/scratch"
    if scratch not in _SCRATCH:
        hpath = sc._jvm.org.apache.hadoop.fs.Path(scratch)
        fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(hpath)                     # only what exists is deleted on exit
        fs.deleteOnExit(hpath)
        _SCRATCH.add(scratch)
    return "/".join([scratch, *parts]) + f"-{uuid.uuid4().hex[:12]}"


_SCRATCH: set[str] = set()
