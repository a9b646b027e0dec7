"""Query registry: ``@register(name, sql)`` records a (spark, sf_dir) ->
DataFrame callable and, when the operation is SQL-expressible, the
equivalent ANSI SQL (DuckDB dialect) used as an independent oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, tuple[str, ...]] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn

    return deco
