"""Hot keys and skew-safe joins.

AQE already splits skewed sort-merge-join partitions at run time
(``spark.sql.adaptive.skewJoin.enabled``) and broadcasts a side that turns out
small. These helpers make the split explicit where a plan must not depend on
that:

* ``hot_keys``: keys (NULL included) holding at least ``min_share`` of the rows.
  There can be at most ``1 / min_share`` of them.
* ``salted_join``: rows of a hot key are dealt over as many buckets as its row
  count asks for, by a hash of columns that identify a row; the other side's
  rows of that key are copied once per bucket. Same rows as the plain join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a join task should get at most, about.
ROWS_A_TASK = 1_000_000


def key_counts(df: DataFrame, key: str | Column) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(df: DataFrame, key: str | Column, min_share: float = 0.01) -> DataFrame:
    """key, n, share for keys with share >= min_share (at most 1/min_share rows).

    The total is a plain count (no shuffle) that comes back to the driver as
    one number; the per-key counts are partially aggregated before their
    shuffle, so a key with a third of the rows costs one row per task.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    total = df.count()
    counts = key_counts(df, key)
    if total == 0:
        return counts.withColumn("share", F.lit(0.0)).where(F.lit(False))
    return (counts.where(F.col("n") >= F.lit(min_share * total))
            .withColumn("share", F.col("n") / F.lit(float(total)))
            .orderBy(F.desc("n"), "key"))


def hot_key_salts(df: DataFrame, key: str | Column, min_share: float = 0.01,
                  rows_a_task: int = ROWS_A_TASK) -> dict:
    """{hot key: buckets}, from exact counts; at most 1/min_share entries. Keys
    whose rows fit one task are left out."""
    return {r["key"]: -(-r["n"] // rows_a_task) for r in hot_keys(df, key, min_share).collect()
            if r["n"] > rows_a_task}


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, salts: Mapping,
                row_id: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join ``big.big_key = small.small_key`` with the rows of the keys in
    ``salts`` (see :func:`hot_key_salts`) dealt over that many buckets. ``how``
    is ``inner`` or ``left`` (big side outer).

    ``row_id``: columns that tell the rows of a key apart, so that equal rows
    elsewhere do not pile up, and a recomputed task after an executor loss puts
    every row in its bucket again. NULL keys match nothing; in a left join their
    rows are dealt out like any other hot key's.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if not row_id:
        raise ValueError("row_id names the columns that tell the rows of a key apart")
    salts = dict(salts)
    nulls = salts.pop(None, 1)
    if not salts and nulls == 1:
        return big.join(small, big[big_key] == small[small_key], how)

    def buckets(key: Column) -> Column:
        n = F.when(key.isNull(), F.lit(int(nulls)))
        if salts:
            n = n.otherwise(F.coalesce(
                F.try_element_at(F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]), key), F.lit(1)))
        else:
            n = n.otherwise(F.lit(1))
        return n.cast("long")

    b = big.withColumn("__salt", F.pmod(F.xxhash64(*row_id), buckets(F.col(big_key))))
    s = small.where(F.col(small_key).isNotNull()).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("long"), buckets(F.col(small_key)) - 1)))
    joined = b.join(s, (b[big_key] == s[small_key]) & (b["__salt"] == s["__salt"]), how)
    return joined.drop(b["__salt"]).drop(s["__salt"])
