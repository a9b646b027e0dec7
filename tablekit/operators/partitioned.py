"""Changes to a partitioned Parquet table that rewrite only the partitions they touch.

A change first finds the partitions with a row it concerns (one aggregate over
the columns the predicate or the keys need), then writes those anew with
Spark's dynamic partition overwrite; the files of all others stay as they are.
Partitions that end up empty are deleted after the write. What reaches the
driver is one row for each touched partition.

Partitions are replaced one after the other, when the write's job commits. A
change that was cut off can be run again: each is written to give the same
table when repeated.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekit.operators import dml


@dataclass(frozen=True)
class PartitionedTable:
    """A folder of Parquet files, its schema (partition columns included) and its partition columns."""
    spark: SparkSession
    path: str
    schema: StructType
    parts: tuple[str, ...]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def overwrite(self, rows: DataFrame) -> None:
        """Replaces the partitions that ``rows`` has, and no other. Rows are dealt
        by partition first, large partitions over several tasks."""
        (rows.select(*self.schema.fieldNames()).hint("rebalance", *self.parts).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*self.parts).parquet(self.path))

    def within(self, found: Sequence[Row]) -> Column:
        """Rows of the given partitions; becomes a partition filter of the scan."""
        one = [functools.reduce(Column.__and__, [F.col(p).eqNullSafe(F.lit(r[p]).cast(self.schema[p].dataType))
                                                 for p in self.parts]) for r in found]
        return functools.reduce(Column.__or__, one, F.lit(False))

    def key(self, row: Row) -> tuple:
        return tuple(row[p] for p in self.parts)


def create(df: DataFrame, path: str, parts: Sequence[str]) -> PartitionedTable:
    df.hint("rebalance", *parts).write.mode("errorifexists").partitionBy(*parts).parquet(path)
    rest = [f for f in df.schema.fields if f.name not in parts]
    return PartitionedTable(df.sparkSession, path, StructType([*rest, *[df.schema[p] for p in parts]]), tuple(parts))


def _touched(t: PartitionedTable, rows: DataFrame, hit: Column) -> list[Row]:
    """Each partition with a hit: its rows, its hits and one of its files."""
    return (rows.groupBy(*t.parts)
            .agg(F.count_if(hit).alias("__hits"), F.count(F.lit(1)).alias("__rows"), F.min("__file").alias("__file"))
            .where("__hits > 0").collect())


def _with_file(t: PartitionedTable) -> DataFrame:
    return t.read().select("*", F.col("_metadata.file_path").alias("__file"))


def _drop(t: PartitionedTable, row: Row) -> None:
    jvm = t.spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["__file"])).getParent()
    folder.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _report(found: list[Row], rewritten: int, dropped: int) -> dict[str, int]:
    return {"rows": sum(r["__hits"] for r in found), "rewritten": rewritten, "dropped": dropped}


def delete_in_place(t: PartitionedTable, cond: Column | str) -> dict[str, int]:
    """DELETE ... WHERE cond: rows deleted, partitions written anew, partitions removed."""
    hit = dml.predicate(cond)
    found = _touched(t, _with_file(t), hit)
    some = [r for r in found if r["__hits"] < r["__rows"]]
    if some:
        t.overwrite(t.read().where(t.within(some)).where(~hit))
    for r in (gone := [r for r in found if r["__hits"] == r["__rows"]]):
        _drop(t, r)
    return _report(found, len(some), len(gone))


def update_in_place(t: PartitionedTable, cond: Column | str, assignments: Mapping[str, object]) -> dict[str, int]:
    """UPDATE ... SET ... WHERE cond. Rows may move to other partitions; those are then touched as well."""
    hit = dml.predicate(cond)
    found = _touched(t, _with_file(t), hit)
    if not found:
        return _report(found, 0, 0)
    moves = any(c in t.parts for c in assignments)
    there = []
    if moves:
        there = (dml.update_where(t.read().where(t.within(found)).where(hit), F.lit(True), assignments)
                 .select(*t.parts).distinct().collect())
    goals = {t.key(r) for r in there}
    both = list({t.key(r): r for r in [*found, *there]}.values())
    t.overwrite(dml.update_where(t.read().where(t.within(both)), cond, assignments))
    gone = [r for r in found if r["__hits"] == r["__rows"] and moves and t.key(r) not in goals]
    for r in gone:
        _drop(t, r)
    return _report(found, len(both) - len(gone), len(gone))


def merge_in_place(t: PartitionedTable, source: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """MERGE ... ON keys, matched rows replaced, others inserted (as
    :func:`dml.merge_upsert`). ``source`` is read several times: pass a stored
    one. Partitions without a matched key and without source rows stay."""
    keys = list(keys)
    dml.check_schema(t.schema, source.schema, evolve=False)
    if {c.lower() for c in source.columns} != {c.lower() for c in t.schema.fieldNames()}:
        raise dml.SchemaMismatch("UPDATE SET * / INSERT * need the same columns on both sides")
    marks = (source.where(dml.all_not_null(keys)).select(*[F.col(k).alias(f"__{k}") for k in keys])
             .distinct().withColumn("__hit", F.lit(True)))
    same = functools.reduce(Column.__and__, [F.col(k) == F.col(f"__{k}") for k in keys])
    rows = _with_file(t).select(*{*keys, *t.parts}, "__file").join(marks, same, "left")
    found = _touched(t, rows, F.coalesce("__hit", F.lit(False)))
    there = source.select(*t.parts).distinct().collect()
    goals = {t.key(r) for r in there}
    both = list({t.key(r): r for r in [*found, *there]}.values())
    if both:
        old = t.read().where(t.within(both))
        t.overwrite(dml.merge_upsert(old, source.select(*t.schema.fieldNames()), keys))
    gone = [r for r in found if r["__hits"] == r["__rows"] and t.key(r) not in goals]
    for r in gone:
        _drop(t, r)
    return _report(found, len(both) - len(gone), len(gone))
