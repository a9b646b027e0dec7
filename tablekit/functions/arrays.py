"""Array helpers built on Spark's higher-order functions.

Everything here is a Catalyst expression evaluated inside whole-stage
codegen; nothing crosses to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def collect_sorted(df: DataFrame, key: str, value: str, alias: str = "values") -> DataFrame:
    """One sorted array of ``value`` per ``key`` (collect_list order is not
    defined, so sort it). Arrays are per key, so the row count of a key
    bounds the array."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(alias))


def map_elements(col: str | Column, fn) -> Column:
    """transform(values, fn), NULL for a NULL array."""
    return F.transform(_c(col), fn)


def above(col: str | Column, threshold) -> Column:
    """filter(values, x -> x > threshold)."""
    return F.filter(_c(col), lambda x: x > threshold)


def contains_value(col: str | Column, value) -> Column:
    """exists(values, x -> x = value); three-valued like SQL (NULL element
    and no match -> NULL)."""
    return F.exists(_c(col), lambda x: x == value)


def fold_elements(col: str | Column, start: Column, merge, finish=None) -> Column:
    """aggregate(values, start, merge[, finish])."""
    return F.aggregate(_c(col), start, merge, finish) if finish else F.aggregate(_c(col), start, merge)


def sum_of_squares(col: str | Column) -> Column:
    """aggregate(v, 0D, (acc, x) -> acc + double(x)^2)."""
    return F.aggregate(_c(col), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double") * x.cast("double"))


def explode_collect(df: DataFrame, keep: str | list[str], col: str, fn, alias: str) -> DataFrame:
    """The explode -> compute -> collect spelling of ``transform``.

    Each input row gets a row id first (taken right after the input's scan,
    where it is stable across task retries), so every group is exactly one
    input array, whatever the ``keep`` columns' duplicates or skew.
    ``posexplode`` keeps each element's position so the rebuilt array has the
    original order (plain collect_list would not guarantee it). Costs a
    shuffle on the row id; prefer :func:`map_elements`.
    Empty / NULL arrays produce no row (explode drops them).
    """
    keep = [keep] if isinstance(keep, str) else list(keep)
    tagged = df.select(F.monotonically_increasing_id().alias("__rid"), *keep, col)
    exploded = tagged.select("__rid", *keep, F.posexplode(col).alias("pos", "v"))
    return (exploded.groupBy("__rid", *keep)
            .agg(F.array_sort(F.collect_list(F.struct("pos", fn(F.col("v")).alias("v"))))
                 .alias("__pairs"))
            .select(*keep, F.transform("__pairs", lambda p: p["v"]).alias(alias)))
