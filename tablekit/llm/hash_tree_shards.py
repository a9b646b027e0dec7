"""Sharding by a hierarchical weighted hash tree (operator 12), DataFrame functions only.

A document descends three levels: region, rack, shard. At each level every
branch draws ``-ln(u) / weight`` from a hash of the document's id and the
branch's name, and the least draw wins, so a branch gets rows in proportion to
its weight and a row costs one draw a branch on its way, not one a shard.

Weights change by *slices*. A slice is a part of the tree's capacity with its
own branches; the first slice of a region holds its first shards, and every
later shard brings a slice of its own into its region. All slices draw together
at the top. A row whose least draw is an old slice's descends as before, a row
whose least draw is the new slice's goes to the new shard: a region, a rack and
a shard grow by the new weight, and no row moves between others.

Law: ``key``. The id and the number of shards decide; one more shard takes rows
only into itself. Copies of a text under other ids are other keys.

Slots number a shard's rows in the order of (doc_id, text_crc32, size). Rows
are range-partitioned in that order, rows equal in all of it by a salt as well
(they are interchangeable), numbered within each range, and each range starts
where the ones before it end: no shard, and no repeated row, meets in one task.

Defined cases: a null doc_id is a key of its own; a null text has size 16 and
CRC 0, as the empty text; rows that share a doc_id share a shard; an empty table
gives an empty result; other columns are ignored by the query and pass through
``write_shards`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import crc32_sql, stored, table

SHARDS, RACKS, RACK_SHARDS = 40, 4, 2


class Branch(NamedTuple):
    """One place in the tree; the weight is its shard's capacity."""
    slice: str
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, racks: int = RACKS, rack_shards: int = RACK_SHARDS) -> list[Branch]:
    """Shards 0, 1, ... filled into racks and regions in order; a slice a region."""
    out = []
    for s in range(shards):
        rack = s // rack_shards
        region = f"r{rack // racks}"
        out.append(Branch(region, region, f"{region}k{rack % racks}", s))
    return out


def grown(tree: Sequence[Branch], region: str | None = None, rack: str | None = None,
          weight: float = 1.0) -> list[Branch]:
    """One more shard, in a slice of its own, beside the last one unless told otherwise."""
    last = tree[-1]
    shard = max(b.shard for b in tree) + 1
    return [*tree, Branch(f"s{shard}", region or last.region, rack or last.rack, shard, weight)]


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def _nested(tree: Sequence[Branch]) -> list[tuple]:
    """The tree as (name, weight, below): slices over racks over (name, weight, shard)."""
    out: dict[str, dict[str, list[Branch]]] = {}
    for b in tree:
        out.setdefault(b.slice, {}).setdefault(b.rack, []).append(b)
    return [(name, float(sum(b.weight for bs in racks.values() for b in bs)),
             [(f"{name}/{rack}", float(sum(b.weight for b in bs)),
               [(f"{name}/{rack}/{b.shard}", float(b.weight), b.shard) for b in bs]) for rack, bs in racks.items()])
            for name, racks in out.items()]


def _literal(options) -> Column:
    if not isinstance(options, list):
        return F.lit(options)
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"), _literal(below).alias("below"))
                     for name, weight, below in options])


def _below_least(key: Column, options: Column) -> Column:
    """What lies below the branch with the least draw: an exponential with the
    branch's weight as rate, from 52 bits of a digest (never ln(0))."""
    def drawn(b: Column, i: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("@"), b["name"])), 1, 13), 16, 10).cast("double")
        return F.struct((-F.ln((bits + 1) / float(1 << 52)) / b["weight"]).alias("draw"), i.alias("i"), b["below"].alias("below"))

    return F.array_min(F.transform(options, drawn))["below"]


def shard_of(doc_id: Column, tree: Sequence[Branch]) -> Column:
    """The shard (int) of an id: a draw for each slice, then for each rack of the
    chosen slice, then for each shard of the chosen rack."""
    key = _key(doc_id)
    below = _literal(_nested(tree))
    for _ in range(3):
        below = _below_least(key, below)
    return below.cast("int")


def assigned(docs: DataFrame, tree: Sequence[Branch], larger: Sequence[Branch] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row;
    ``larger``: the tree with more shards that grown_shard refers to."""
    text = F.coalesce(F.col("text"), F.lit(""))
    after = shard_of(F.col("doc_id"), larger) if larger is not None else F.lit(None).cast("int")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        shard_of(F.col("doc_id"), tree).alias("shard"), after.alias("grown_shard"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    # finding the ranges reads the rows once more: narrow ones, not the texts
    rows = stored(rows, "shard_keys")
    order = ["doc_id", "text_crc32", "size", "salt"]
    # a range's number depends on the layout: written once, then read by all that follows
    ranged = stored(rows.repartitionByRange("shard", *order).withColumn("part", F.spark_partition_id()), "shard_rows")
    # ranges ascend by shard: about a row a range and a row a shard
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
              .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order))
    return (ranged.withColumn("place", place).join(F.broadcast(starts), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, tree: Sequence[Branch]) -> str:
    """Writes all columns of ``docs`` into one folder a shard; large shards are
    split over tasks by size, small ones share one."""
    placed = docs.withColumn("shard", shard_of(F.col("doc_id"), tree)) if "shard" not in docs.columns else \
        docs.withColumnRenamed("shard", "own_shard").withColumn("shard", shard_of(F.col("doc_id"), tree))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return path


def op12(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards (5 regions, 4 racks, 2 shards), and where a 41st would put them."""
    tree = even_tree(SHARDS)
    return assigned(table(spark, sf_dir, "documents").select("doc_id", "text"), tree, grown(tree))


# -- the same in SQL ---------------------------------------------------------
def _sql_literal(options) -> str:
    if not isinstance(options, list):
        return str(options)
    return "[" + ", ".join(f"{{'name': '{n}', 'weight': {w}::DOUBLE, 'below': {_sql_literal(below)}}}"
                           for n, w, below in options) + "]"


def _sql_shard(tree: Sequence[Branch]) -> str:
    below = _sql_literal(_nested(tree))
    for _ in range(3):
        below = (f"list_min(list_transform({below}, lambda b, i: {{'draw': -ln((CAST('0x' || substr(md5(key || '@' ||"
                 " b.name), 1, 13) AS BIGINT) + 1) / 4503599627370496.0) / b.weight, 'i': i, 'below': b.below})).below")
    return f"CAST({below} AS INTEGER)"


_TREE = even_tree(SHARDS)
OP12_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key FROM documents
), summed AS (
  SELECT doc_id, key, strlen(t) + 16 AS size,
         {crc32_sql('t')} AS text_crc32
  FROM docs
), placed AS (
  SELECT doc_id, size, text_crc32, {_sql_shard(_TREE)} AS shard, {_sql_shard(grown(_TREE))} AS grown_shard FROM summed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""
