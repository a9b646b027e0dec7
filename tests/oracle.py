"""Spark-vs-DuckDB comparison used by the tests and ``check_oracle.py``.

Mirrors the driver's gate: same row count, same column names, same coarse
column types, and the same multiset of rows (columns sorted by name, floats
compared after rounding, order ignored).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):          # a Spark-written table directory
            path = f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, (float, decimal.Decimal)):
        return "float"
    if isinstance(v, str):
        return "str"
    if isinstance(v, (dt.datetime, dt.date)):
        return "time"
    if isinstance(v, (list, tuple)):
        return "list"
    if isinstance(v, dict):
        return "map"
    return type(v).__name__


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    return v


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    return cols, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    rows = rel.fetchall()
    return cols, rows


def compare(spark_df, con, sql, digits=6) -> dict:
    scols, srows = spark_rows(spark_df)
    dcols, drows = duck_rows(con, sql)
    out = {"rows_spark": len(srows), "rows_oracle": len(drows)}
    if sorted(scols) != sorted(dcols):
        out["error"] = f"columns differ: spark={sorted(scols)} oracle={sorted(dcols)}"
        return out
    so = sorted(range(len(scols)), key=lambda i: scols[i])
    do = [dcols.index(scols[i]) for i in so]
    sn = [tuple(_norm(r[i], digits) for i in so) for r in srows]
    dn = [tuple(_norm(r[i], digits) for i in do) for r in drows]
    # coarse type check per column (first non-null value)
    for k, (si, di) in enumerate(zip(so, do)):
        sk = next((_kind(r[si]) for r in srows if r[si] is not None), "null")
        dk = next((_kind(r[di]) for r in drows if r[di] is not None), "null")
        if "null" not in (sk, dk) and sk != dk:
            out["error"] = f"type of {scols[si]}: spark={sk} oracle={dk}"
            return out
    if len(srows) != len(drows):
        out["error"] = "row count differs"
        return out
    key = lambda t: repr(t)
    if sorted(sn, key=key) != sorted(dn, key=key):
        a, b = set(sn), set(dn)
        out["error"] = (f"values differ: {len(a - b)} spark-only e.g. {list(a - b)[:2]}, "
                        f"{len(b - a)} oracle-only e.g. {list(b - a)[:2]}")
        return out
    out["ok"] = True
    return out
