"""Commits as a table and the change feed."""

import datetime as dt

from pyspark.sql import functions as F

from tablekit.operators import commits as CM
from tablekit.operators import dml
from tablekit.operators import versions as V

UTC = dt.timezone.utc


def base(spark):
    return spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", 5), (3, None, 7), (3, None, 7), (4, "d", 9)],
                                 "k int, s string, v int")


def chain(spark):
    v = V.first_version(base(spark))
    v = V.update_where(v, 1, "k IN (1, 2)", {"v": 5})                 # k = 2 has it already
    v = V.delete_where(v, 2, "k = 3")
    v = V.append(v, 3, base(spark).where("k = 3"))                    # what went comes back
    return V.restore(v, 4, to=0)


def rows(df):
    return sorted(map(str, df.collect()))


def test_net_changes_equal_except_all_on_repeated_and_null_rows(spark, scratch):
    chain(spark).write.parquet(scratch + "/v")
    v = spark.read.parquet(scratch + "/v")
    for a in range(5):
        for b in range(a, 5):
            want = dml.diff(V.as_of(v, a), V.as_of(v, b))
            assert rows(V.net_changes(v, a, b).select(want.columns)) == rows(want), (a, b)


def test_the_feed_names_each_version(spark):
    feed = {(r.version, r.change): r.n for r in V.changes(chain(spark), 0, 4).groupBy("version", "change")
            .agg(F.count("*").alias("n")).collect()}
    assert feed == {(1, "delete"): 2, (1, "insert"): 2, (2, "delete"): 2, (3, "insert"): 2, (4, "delete"): 4, (4, "insert"): 4}
    assert V.changes(chain(spark), 4, 9).count() == 0


def test_the_feed_is_one_scan_without_a_shuffle(spark, scratch):
    chain(spark).write.parquet(scratch + "/v")
    plan = V.changes(spark.read.parquet(scratch + "/v"), 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert "PushedFilters: [Or(" in plan


def test_saved_commits_count_what_they_wrote(spark, scratch):
    log = scratch + "/commits"
    at = [dt.datetime(2024, 1, 1, h, tzinfo=UTC) for h in range(4)]
    v = CM.save(V.first_version(base(spark)), scratch + "/v0", log, 0, "CREATE", at=at[0])
    v = CM.save(V.delete_where(v, 1, "k = 3"), scratch + "/v1", log, 1, "DELETE", "k = 3", at=at[1])
    v = CM.save(V.update_where(v, 2, "k = 1", {"v": 0}), scratch + "/v2", log, 2, "UPDATE", "k = 1", at=at[2])
    got = [tuple(r)[2:] for r in CM.read(spark, log).orderBy("version").collect()]
    assert got == [("CREATE", None, 6, 0, 6), ("DELETE", "k = 3", 0, 2, 4), ("UPDATE", "k = 1", 2, 2, 4)]
    for n, when in enumerate(at[:3]):
        later = when + dt.timedelta(minutes=30)
        assert rows(CM.as_of_time(v, CM.read(spark, log), later)) == rows(V.as_of(v, n))
    east = dt.datetime(2024, 1, 1, 5, 30, tzinfo=dt.timezone(dt.timedelta(hours=5)))      # 00:30 in UTC
    assert rows(CM.as_of_time(v, CM.read(spark, log), east)) == rows(V.as_of(v, 0))
    assert CM.as_of_time(v, CM.read(spark, log), at[0] - dt.timedelta(seconds=1)).count() == 0


def test_added_rows_are_the_only_files_written(spark, scratch):
    path, log = scratch + "/rows", scratch + "/log"
    days = [spark.createDataFrame([(n, dt.datetime(2024, 1, n + 1, tzinfo=UTC))], "k int, at timestamp") for n in range(3)]
    seen = []
    for n, day in enumerate(days):
        CM.add_rows(day, path, log, n, "at")
        seen.append(set(spark.read.parquet(path).select("_metadata.file_path").distinct().toPandas()["file_path"]))
    assert seen[0] < seen[1] < seen[2]
    log_rows = CM.read(spark, log).orderBy("version").collect()
    assert [(r.rows_added, r.rows_closed, r.rows_live) for r in log_rows] == [(1, 0, 1), (1, 0, 2), (1, 0, 3)]
    assert [r.committed_at.day for r in log_rows] == [1, 2, 3]
    CM.add_rows(days[0].limit(0), path, log, 3, "at")                    # nothing to add: committed now
    assert CM.read(spark, log).where("version = 3").first().rows_live == 3
