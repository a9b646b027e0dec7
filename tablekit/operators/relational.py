"""Relational helpers that are thin, declarative compositions of DataFrame
calls -- Catalyst sees the whole plan and pushes filters / prunes columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANKERS = {
    "dense": F.dense_rank,
    "rank": F.rank,
    "row": F.row_number,
}


def derive(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Add / replace several columns in one projection (one ``Project`` node
    instead of a chain of ``withColumn``)."""
    cols = {k: (F.expr(v) if isinstance(v, str) else v) for k, v in columns.items()}
    return df.withColumns(cols)


def yes_no(col: str | Column) -> Column:
    """'yes' -> true, 'no' -> false, anything else (incl. NULL) -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    low = F.lower(F.trim(c))
    return F.when(low == "yes", F.lit(True)).when(low == "no", F.lit(False))


def label01(col: str | Column) -> Column:
    """Boolean to 1.0 / 0.0 label, NULL counts as 0.0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))


def class_balance(df: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Total / positive / negative counts in one pass (partial aggregation
    map-side, so a hot group costs one row per task in the shuffle)."""
    aggs = [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col(flag)).alias("n_pos"),
        F.count_if(~F.coalesce(F.col(flag), F.lit(False))).alias("n_neg"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def top_n_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                    n: int, rank: str = "dense", rank_col: str = "rank") -> DataFrame:
    """Rows whose rank within their group is <= n (ties kept for rank/dense).

    Spark inserts a partial ``WindowGroupLimit`` below the shuffle for this
    shape, so each task forwards at most ~n rows (plus ties) per group: a group
    holding a third of the table does not ship a third of the table.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, RANKERS[rank]().over(w)).where(F.col(rank_col) <= n)


def pivot(df: DataFrame, group_by: Sequence[str], pivot_col: str | Column,
          values: Mapping[object, str], aggs: Mapping[str, Column | Callable[[Column], Column]],
          value_col: str | Column | None = None) -> DataFrame:
    """Pivot with listed values and value aliases.

    ``values`` maps a pivot value to its alias (``{1: "JAN"}``), ``aggs`` maps
    an aggregate alias to the aggregate. Output columns are
    ``<value alias>_<agg alias>`` (or just ``<value alias>`` for a single
    aggregate, as SQL PIVOT names them).

    * ``aggs`` as functions (``{"MaxDelay": F.max}``) with ``value_col``: one
      conditional aggregate per (value, agg) -- ``max(CASE WHEN p = v THEN x
      END)`` -- so the pivot is a single partially-aggregated shuffle.
    * ``aggs`` as aggregate Columns: Spark's ``pivot`` (a two-phase aggregate
      that stays compact for long value lists).
    """
    pc = F.col(pivot_col) if isinstance(pivot_col, str) else pivot_col
    single = len(aggs) == 1

    def name(valias: str, aalias: str) -> str:
        return valias if single else f"{valias}_{aalias}"

    if all(callable(a) and not isinstance(a, Column) for a in aggs.values()):
        if value_col is None:
            raise ValueError("aggregate functions need value_col")
        x = F.col(value_col) if isinstance(value_col, str) else value_col
        cols = [fn(F.when(pc == F.lit(v), x)).alias(name(valias, aalias))
                for v, valias in values.items() for aalias, fn in aggs.items()]
        return df.groupBy(*group_by).agg(*cols)
    keyed = df.withColumn("__pv", pc)
    out = keyed.groupBy(*group_by).pivot("__pv", list(values.keys())).agg(
        *[a.alias(n) for n, a in aggs.items()])
    renames = {}
    for v, valias in values.items():
        for aalias in aggs:
            renames[str(v) if single else f"{v}_{aalias}"] = name(valias, aalias)
    return out.withColumnsRenamed(renames)


def grouping_sets(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                  kind: str = "rollup") -> DataFrame:
    """ROLLUP / CUBE over ``keys`` (NULL key = subtotal)."""
    g = df.rollup(*keys) if kind == "rollup" else df.cube(*keys)
    return g.agg(*aggs)


def distinct_count(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Count of distinct non-NULL values (the ``select(c).distinct().count()``
    idiom minus the NULL, as one aggregate)."""
    return df.agg(F.count_distinct(F.col(col)).alias(alias or f"n_distinct_{col}"))
