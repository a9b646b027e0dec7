"""Run in its own process (master local[4,4]: a failed task is retried up
to 4 times). The first attempt of one task in each job below raises, the
way a lost executor would; the results must equal the failure-free ones."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType  # noqa: E402

from tablekit.operators import skew as SK  # noqa: E402
from tablekit.operators import versions as V  # noqa: E402
from tablekit.session import shared_dir, tune  # noqa: E402
from tablekit.sources import items, skewed_sales  # noqa: E402
from tablekit.streaming import ingest  # noqa: E402


MARKERS = tempfile.mkdtemp(prefix="tk-fault-markers-")
os.environ["TK_FAULT_MARKERS"] = MARKERS     # inherited by the Python workers


@F.pandas_udf(LongType())
def fail_first_attempt(s: pd.Series) -> pd.Series:
    tc = TaskContext.get()
    if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() == 0:
        marker = os.path.join(os.environ["TK_FAULT_MARKERS"],
                              f"stage{tc.stageId()}-part{tc.partitionId()}")
        open(marker, "w").close()
        raise RuntimeError("injected task failure")
    return s


def main():
    spark = (SparkSession.builder.master("local[4,4]").appName("tk-faults")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tk-faults-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    tune(spark)
    out = {}
    sf = "/root/testdata/sf0.01"

    # 1. a version written by a job that loses a task
    cust = spark.read.parquet(f"{sf}/customer.parquet").repartition(4)
    flaky = cust.withColumn("c_custkey", fail_first_attempt("c_custkey"))
    path = shared_dir(spark, "faults", "versions", unique=True)
    V.delete_where(V.first_version(flaky), 1, "c_acctbal < 0").write.parquet(path)
    got = V.as_of(spark.read.parquet(path), 0)
    out["version_rows"] = got.count()
    out["version_distinct"] = got.select("c_custkey").distinct().count()
    out["expected_rows"] = cust.count()

    # 2. salted join with a failure in the map stage that computes the salts
    s = skewed_sales(spark, 40000, 2000, seed=3).withColumn("row_id", F.monotonically_increasing_id())
    i = items(spark, 2000)
    plain = sorted(map(tuple, s.join(i, s.s_item_id == i.i_item_id)
                       .groupBy("s_date").agg(F.sum("s_quantity").alias("q")).collect()))
    s_flaky = s.withColumn("s_quantity", fail_first_attempt(F.col("s_quantity").cast("long")))
    salted = SK.salted_join(s_flaky, i, "s_item_id", "i_item_id", {100: 8}, ["row_id"])
    got_join = sorted(map(tuple, salted.groupBy("s_date").agg(F.sum("s_quantity").alias("q"))
                          .collect()))
    out["salted_equal"] = plain == got_join

    # 3. streaming ingest whose micro-batch loses a task
    src = shared_dir(spark, "faults", "landing", unique=True)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    ev.repartition(4).write.parquet(src)
    target = shared_dir(spark, "faults", "events", unique=True)
    stream = ingest.stream_files(spark, "parquet", src, ev.schema)
    stream = stream.withColumn("event_id", fail_first_attempt("event_id"))
    ingest.run_once(stream, target, target + "_ckpt")
    loaded = spark.read.parquet(target)
    out["stream_rows"] = loaded.count()
    out["stream_distinct"] = loaded.select("event_id").distinct().count()
    out["stream_expected"] = ev.count()
    out["injected_failures"] = len(os.listdir(MARKERS))
    print("RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
