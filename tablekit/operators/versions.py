"""Versions of a table kept as data.

A versioned table is a DataFrame whose rows carry ``from_version`` and
``to_version`` (NULL while the row is current). A change closes rows and adds
rows; reading a version, restoring one and repairing from one are filters and
unions, so everything stays one declarative plan and writes like any other
DataFrame. A table of commits (version, committed_at, operation) belongs to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators import dml

SPAN = ("from_version", "to_version")


def first_version(df: DataFrame) -> DataFrame:
    return added(df, 0)


def added(df: DataFrame, version: int) -> DataFrame:
    return df.withColumns({"from_version": F.lit(version), "to_version": F.lit(None).cast("int")})


def _closed(v: DataFrame, version: int, which: Column) -> DataFrame:
    return v.withColumn("to_version", F.when(F.col("to_version").isNull() & which, F.lit(version))
                        .otherwise(F.col("to_version")))


def as_of(v: DataFrame, version: int) -> DataFrame:
    """The table as it was at ``version``."""
    return v.where(live_at(version)).drop(*SPAN)


def live_at(version) -> Column:
    return (F.col("from_version") <= version) & (F.col("to_version").isNull() | (F.col("to_version") > version))


def latest(v: DataFrame) -> DataFrame:
    return v.where(F.col("to_version").isNull()).drop(*SPAN)


def delete_where(v: DataFrame, version: int, cond: Column | str) -> DataFrame:
    return _closed(v, version, dml.predicate(cond))


def update_where(v: DataFrame, version: int, cond: Column | str, assignments: Mapping[str, object]) -> DataFrame:
    """Closes and adds the rows that the update changes; a row that has the new
    values already stays as it is."""
    hit = dml.predicate(cond) & _differs(v, assignments)
    new = dml.update_where(latest(v).where(hit), F.lit(True), assignments)
    return _closed(v, version, hit).unionByName(added(new, version))


def _differs(v: DataFrame, assignments: Mapping[str, object]) -> Column:
    out = F.lit(False)
    for c, value in assignments.items():
        if c not in v.columns:
            raise dml.SchemaMismatch(f"no column {c}")
        value = value if isinstance(value, Column) else F.lit(value)
        out = out | ~F.col(c).eqNullSafe(value.cast(v.schema[c].dataType))
    return out


def append(v: DataFrame, version: int, rows: DataFrame, evolve: bool = False) -> DataFrame:
    """Appends with the schema rules of :func:`dml.append`; with ``evolve`` older
    rows get NULL in new columns."""
    dml.check_schema(v.drop(*SPAN).schema, rows.schema, evolve)
    return v.unionByName(added(rows, version), allowMissingColumns=True)


def merge(v: DataFrame, version: int, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: current rows with a partner in ``source`` are closed, all source
    rows are added."""
    keys = list(keys)
    checked = dml.unique_keys(source, keys)
    marks = checked.select(*[F.col(k).alias(f"__{k}") for k in keys]).where(
        dml.all_not_null([f"__{k}" for k in keys])).withColumn("__hit", F.lit(True))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    hit = v.join(marks, cond, "left")
    closed = _closed(hit, version, F.col("__hit").isNotNull()).select(*v.columns)
    return closed.unionByName(added(source.select(*[c for c in v.columns if c not in SPAN]), version))


def restore(v: DataFrame, version: int, to: int) -> DataFrame:
    """A new version with the rows of version ``to``. Rows that both hold stay open."""
    then = live_at(to)
    back = v.where(then & F.col("to_version").isNotNull()).drop(*SPAN)
    return _closed(v, version, ~then).unionByName(added(back, version))


def changes(v: DataFrame, after: int, until: int) -> DataFrame:
    """The change feed: every row added (``insert``) or closed (``delete``) in the
    versions ``after`` < version <= ``until``, with the version that did it. Read
    off the spans: one scan, no shuffle, filters on the spans reach the files. A
    row that came and went in between is there twice."""
    born = F.col("from_version").between(after + 1, until)
    gone = F.col("to_version").between(after + 1, until)
    kinds = F.array_compact(F.array(
        F.when(gone, F.struct(F.lit("delete").alias("change"), F.col("to_version").alias("version"))),
        F.when(born, F.struct(F.lit("insert").alias("change"), F.col("from_version").alias("version")))))
    data = [c for c in v.columns if c not in SPAN]
    return (v.where(born | gone).select(*data, F.explode(kinds).alias("__k"))
            .select(*data, F.col("__k.change").alias("change"), F.col("__k.version").alias("version")))


def net_changes(v: DataFrame, after: int, until: int) -> DataFrame:
    """What differs between two versions: the rows of EXCEPT ALL both ways, from
    the changed rows alone. Rows that came and went cancel out."""
    data = [c for c in v.columns if c not in SPAN]
    weight = F.when(F.col("change") == "insert", 1).otherwise(-1)
    net = changes(v, after, until).groupBy(*data).agg(F.sum(weight).alias("__n")).where("__n != 0")
    change = F.when(F.col("__n") > 0, "insert").otherwise("delete").alias("change")
    # copies of a repeated row, one at a time
    return net.select(*data, change, F.explode(F.sequence(F.lit(1).cast("long"), F.abs("__n"))).alias("__copy")).drop("__copy")


def row_counts(v: DataFrame, versions: Sequence[int]) -> DataFrame:
    """(version, num_output_rows): one pass, one conditional count a version."""
    counts = [F.count_if((F.col("from_version") <= n) & (F.col("to_version").isNull() | (F.col("to_version") > n)))
              for n in versions]
    one = v.agg(F.array(*[F.struct(F.lit(n).alias("version"), c.alias("num_output_rows"))
                          for n, c in zip(versions, counts)]).alias("all"))
    return one.select(F.explode("all").alias("r")).select("r.version", "r.num_output_rows")


def version_at(commits: DataFrame, when) -> int | None:
    """The newest version committed at or before ``when`` (one aggregate)."""
    return commits.where(F.col("committed_at") <= F.lit(when)).agg(F.max("version")).first()[0]
