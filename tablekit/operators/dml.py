"""Row-level changes as pure DataFrame functions.

Each function maps a table (DataFrame) to its next state, so it can be
checked against SQL and kept as a new version of a table by
:mod:`tablekit.operators.versions`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaMismatch(ValueError):
    """Append / merge with columns the table does not have (or other types)."""


def predicate(cond: Column | str) -> Column:
    """``cond`` as a two-valued predicate: NULL counts as false."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    return F.coalesce(c, F.lit(False))


def delete_where(df: DataFrame, cond: Column | str) -> DataFrame:
    """DELETE ... WHERE cond. A row whose predicate is NULL is kept."""
    return df.where(~predicate(cond))


def update_where(df: DataFrame, cond: Column | str,
                 assignments: Mapping[str, Column | object]) -> DataFrame:
    """UPDATE ... SET col = value WHERE cond (types of the table are kept)."""
    m = predicate(cond)
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for col, v in assignments.items():
        if col not in types:
            raise SchemaMismatch(f"no column {col}")
        val = v if isinstance(v, Column) else F.lit(v)
        new[col] = F.when(m, val.cast(types[col])).otherwise(F.col(col))
    return df.withColumns(new)


def check_schema(table_schema: StructType, incoming: StructType, evolve: bool) -> None:
    """Schema enforcement: every incoming column must exist with the same type,
    unless ``evolve`` (then new columns are added; types must still agree)."""
    have = {f.name.lower(): f.dataType for f in table_schema.fields}
    extra, clash = [], []
    for f in incoming.fields:
        t = have.get(f.name.lower())
        if t is None:
            extra.append(f.name)
        elif t != f.dataType:
            clash.append(f"{f.name}: {t.simpleString()} vs {f.dataType.simpleString()}")
    if clash:
        raise SchemaMismatch("type mismatch: " + ", ".join(clash))
    if extra and not evolve:
        raise SchemaMismatch(
            f"columns {extra} are not in the table schema; append with evolve=True "
            "(mergeSchema) to add them")


def append(df: DataFrame, new_rows: DataFrame, evolve: bool = False) -> DataFrame:
    """INSERT / append with schema enforcement or evolution (by name; columns
    missing on either side become NULL)."""
    check_schema(df.schema, new_rows.schema, evolve)
    return df.unionByName(new_rows, allowMissingColumns=True)


def unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing at run time if a key without NULLs occurs twice. The
    check is part of the plan: no job runs while it is built, and the rows that
    are checked are the rows that are used. Keys are counted map-side first; one
    repeated key (a row at most, so it is broadcast) is enough to fail."""
    keyed = source.where(all_not_null(keys))
    twice = (keyed.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
             .where("__n > 1").limit(1))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    message = f"merge source has duplicate keys on {list(keys)}"
    checked = (keyed.join(F.broadcast(twice), same, "left")
               .where(F.when(F.col("__n").isNotNull(), F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))
               .select(*source.columns))
    return checked.unionByName(source.where(~all_not_null(keys)))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 check_unique: bool = True) -> DataFrame:
    """MERGE INTO target USING source ON keys
         WHEN MATCHED THEN UPDATE SET *  WHEN NOT MATCHED THEN INSERT *.

    = target rows without a partner in source (left anti join on the keys)
      UNION source rows. NULL keys never match, so NULL-key source rows are
    inserted and NULL-key target rows kept. The anti join is a plain equi-join:
    AQE broadcasts a small source and splits skewed target keys.
    """
    keys = list(keys)
    check_schema(target.schema, source.schema, evolve=False)
    if set(c.lower() for c in source.columns) != set(c.lower() for c in target.columns):
        raise SchemaMismatch("UPDATE SET * / INSERT * need the same columns on both sides")
    if check_unique:
        source = unique_keys(source, keys)
    src_keys = source.select(*keys).where(all_not_null(keys))
    kept = target.join(src_keys, on=keys, how="left_anti")
    return kept.unionByName(source.select(*target.columns))


def all_not_null(keys: Sequence[str]) -> Column:
    """True when none of ``keys`` is NULL (NULL keys never match in a merge)."""
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row-level change between two states: ``change = 'delete'`` rows left
    ``before``, ``'insert'`` rows arrived in ``after`` (multiset semantics,
    NULLs compare equal -- the same rows as EXCEPT ALL both ways).

    Spark's own EXCEPT ALL: equal rows are counted map-side before the shuffle
    and copies of a repeated row are produced one at a time.
    """
    return (before.exceptAll(after).withColumn("change", F.lit("delete"))
            .unionByName(after.exceptAll(before).withColumn("change", F.lit("insert"))))
