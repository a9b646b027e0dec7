"""Best-fit packing into several permitted sequence lengths (operator 3).

Texts become token counts (words here); a text longer than the largest length
is cut, its full pieces filling sequences of their own. What is left is packed
by best fit, largest first: a piece goes to the open bin it fills best; if none
takes it, a new bin is opened. All permitted lengths that hold the piece compete
for each opening: the one with the least cost a token is opened, counting as
many tokens as it can hold or as are still to be placed, whichever is less. At
the end every bin is downsized to the least-cost length that holds its contents.
A bin costs its length plus a fixed overhead a sequence unless ``costs`` says
otherwise.

Spark deals the documents by hash to shards of about ``per_shard`` texts, and
each shard is packed by itself: a shard holds only ids and counts, the number
of shards grows with the table, and the loss against one global packing is at
most a few partly filled bins per shard. Rows equal in id and text are counted
before they move and dealt in lots of ``LOT``, so that copies do not pile up.

Defined cases: texts without words take no room and give no row; repeated rows
are packed each; a null doc_id is packed like any other; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import table
from tablekit.llm.temperature_mix import token_count

SIZES = (512, 1024, 2048, 4096)
OVERHEAD = 32
PER_SHARD = 20_000
#: Copies of one row that a shard gets at a time.
LOT = 256
SCHEMA = ("bin long, capacity long, used long, doc_id long, piece long, start long, n_tokens long, offset long")


def least_cost(room: int, sizes, costs) -> int:
    """The cheapest permitted length that holds so many tokens (ties: shorter)."""
    return min((c for c in sizes if c >= room), key=lambda c: (costs[c], c))


def opened(n: int, left: int, sizes, costs) -> int:
    """The length to open for a piece of n tokens with ``left`` still to be placed
    (it included): the least cost a token (ties: shorter)."""
    return min((c for c in sizes if c >= n), key=lambda c: (costs[c] / min(c, left), c))


def best_fit(lengths: list[int], sizes, costs) -> tuple[list[int], list[int], list[int]]:
    """Bin of each length (given largest first), tokens and final capacity of each bin."""
    rooms, stacks = [], {}                 # sorted distinct rooms; open bins by room
    where, used, size = [], [], []
    left = sum(lengths)
    for n in lengths:
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = stacks[room].pop()
            if not stacks[room]:
                del stacks[room], rooms[at]
        else:
            b = len(used)
            used.append(0)
            size.append(opened(n, left, sizes, costs))
        used[b] += n
        left -= n
        where.append(b)
        room = size[b] - used[b]
        if room:
            if room not in stacks:
                stacks[room] = []
                insort(rooms, room)
            stacks[room].append(b)
    return where, used, [least_cost(u, sizes, costs) for u in used]


def pack(items: DataFrame, n_items: int, sizes=SIZES, costs: dict | None = None,
         per_shard: int = PER_SHARD) -> DataFrame:
    """Packs (doc_id, key, n_tokens); SCHEMA, one row per piece."""
    sizes = tuple(sorted(sizes))
    costs = costs or {c: c + OVERHEAD for c in sizes}
    top, shards = sizes[-1], max(1, -(-n_items // per_shard))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(pdf["copies"])]
        pdf = pdf.sort_values(["n_tokens", "doc_id", "key"], kind="stable").reset_index(drop=True)
        n = pdf["n_tokens"].to_numpy()
        full = n // top
        # full pieces: a bin each
        doc = np.repeat(np.arange(len(n)), full)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
        rest = np.flatnonzero(n % top)
        rest = rest[np.argsort(-(n[rest] % top), kind="stable")]
        lengths = (n[rest] % top).tolist()
        where, used, capacity = best_fit(lengths, sizes, costs) if lengths else ([], [], [])
        offset, filled = [], [0] * len(used)
        for b, k in zip(where, lengths):
            offset.append(filled[b])
            filled[b] += k
        where = np.asarray(where, dtype=np.int64)
        at = np.concatenate([doc, rest])
        first = int(pdf["shard"].iloc[0]) << 32
        return pd.DataFrame({
            "bin": first + np.concatenate([np.arange(len(doc)), len(doc) + where]),
            "capacity": np.concatenate([np.full(len(doc), top), np.asarray(capacity, dtype=np.int64)[where]]),
            "used": np.concatenate([np.full(len(doc), top), np.asarray(used, dtype=np.int64)[where]]),
            "doc_id": pdf["doc_id"].array[at],
            "piece": np.concatenate([piece, full[rest]]),
            "start": np.concatenate([piece * top, full[rest] * top]),
            "n_tokens": np.concatenate([np.full(len(doc), top), np.asarray(lengths, dtype=np.int64)]),
            "offset": np.concatenate([np.zeros(len(doc), dtype=np.int64), np.asarray(offset, dtype=np.int64)]),
        })

    lots = (items.where("n_tokens > 0").groupBy("doc_id", "key", "n_tokens").agg(F.count("*").alias("n"))
            .withColumn("lot", F.explode(F.expr(f"sequence(0L, (n - 1) div {LOT})")))
            .withColumn("copies", F.least(F.col("n") - F.col("lot") * LOT, F.lit(LOT))))
    return (lots.withColumn("shard", F.pmod(F.xxhash64("key", "lot"), F.lit(shards)))
            .select("doc_id", "key", "n_tokens", "copies", "shard").groupBy("shard").applyInPandas(run, SCHEMA))


def pack_documents(docs: DataFrame, sizes=SIZES, costs: dict | None = None) -> DataFrame:
    items = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"),
                        token_count(F.col("text")).alias("n_tokens"))
    return pack(items, docs.count(), sizes, costs)


def op3(spark, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 512 to 4096 words."""
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
