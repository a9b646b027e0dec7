"""Date / cast helpers with NULL-on-bad-input semantics (ANSI mode raises on
bad casts and unparsable dates; the notebooks' runtimes returned NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col: str | Column, fmt: str) -> Column:
    """String -> TIMESTAMP_NTZ with a Java date pattern; NULL when it does not parse."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def safe_cast(col: str | Column, typ: str) -> Column:
    """try_cast: bad strings / overflow -> NULL."""
    return _c(col).try_cast(typ)


def days_before(col: str | Column, n: int) -> Column:
    """DATE_ADD(d, -n) as a DATE."""
    return F.date_add(_c(col).cast("date"), -n)


def stamped(df, as_of: str | None = None):
    """``df`` with loaded_at and loaded_on: the session's clock, or the fixed
    time ``as_of``."""
    at = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({"loaded_at": at, "loaded_on": F.to_date(at) if as_of else F.current_date()})


def exact_sum(whole: str):
    """Sum of a whole-number SQL expression as a double, exact beyond a long:
    millions and rest are summed as longs, so no row needs decimal arithmetic."""
    millions, rest = F.expr(f"sum(({whole}) div 1000000)"), F.expr(f"sum(({whole}) % 1000000)")
    return (millions.cast("decimal(20,0)") * 1_000_000 + rest).cast("double")


def money_sum(c):
    """Sum of a money column, in cents."""
    return exact_sum(f"CAST(ROUND({c} * 100) AS BIGINT)") / 100


def money_avg(c):
    return money_sum(c) / F.count(c)
