"""Prefix trie of conversations by time-forward processing (operator 11).

Every distinct sequence of first d turns is a node. Turns become 128-bit hashes
of role and text bound to their place; the exclusive-or of a conversation's
first d hashes names the node, so names are prefix sums and a conversation need
not meet in one task: rows are range-partitioned in their order, each range is
scanned with a running total, and what a range inherits from the ranges before
it is added afterwards (``running``).

Nodes are one partially aggregated group-by of those names. A node is known by
(conv_id, depth), its smallest member and its depth. The nodes of one smallest
member with the same number of members form a *run*: a piece of path on which
nobody ends and nothing branches but at its lower end. Only runs are processed;
a run of one member is a bare path (one leaf, nothing saved).

Time-forward processing over the runs: a run with more than ``most_members``
members is *heavy*, and so is the root's. Below the heavy ones hang subtrees of
at most 2 * most_members runs, which are dealt to shards by the hash of their top.
A shard's runs are sorted externally by level, deepest first, and read once;
each run's totals go as a message to its parent through a priority queue in
the same order, which spills sorted parts when it is long, and are there when
the parent is read. The totals of the shards' tops are then summed by parent, and the heavy
runs are processed in the same way: about (members / most_members) runs a
level, where most_members grows with the square root of the members, so both sides stay small.

Digests of member ids: the ids of a node that end there are sorted by range,
packed into strings of a batch each, and hashed in order, one stream a node:
a node at which a third of all conversations end is a few long strings to its
task, never a list.

Defined cases: rows without conv_id take no part; turns are ordered by turn,
null first, and turns that share a number by a hash of role and text; null role
or text is empty; a conversation may be left without turns (it ends at the
root); repeated rows are turns of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import crc32_sql, stored, table

WORD = r"[^\x20\x09-\x0D]+"
#: Heads come from the conversation at the start of each group of ids.
FAMILY, HEADS = 20, 4
LEAST_MEMBERS, RUNS_PER_SHARD, QUEUE = 4096, 50_000, 200_000


# -- order and prefix names --------------------------------------------------
def running(df: DataFrame, by: str, order: list[Column | str], sums: dict[str, str], xors: dict[str, str],
            name: str) -> DataFrame:
    """``df`` (longs only) with running totals of columns within ``by``, in
    ``order``; ``sums`` and ``xors`` name the result of each column. A ``by`` may be
    spread over any number of tasks."""
    make = {**sums, **xors}
    schema = ", ".join([f"{c} long" for c in df.columns] + [f"{c} long" for c in make.values()] + ["part int"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        last, carry = None, dict.fromkeys(make.values(), 0)
        for pdf in batches:
            n = len(pdf)
            if not n:
                continue
            key = pdf[by].to_numpy()
            first = np.r_[True, key[1:] != key[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0))   # of each row's key
            goes_on = (start == 0) & (key[0] == last)
            new = {}
            for c, out in make.items():
                x = pdf[c].to_numpy(np.int64)
                if c in sums:
                    run = np.cumsum(x)
                    run = run - (run[start] - x[start])
                    run[goes_on] += carry[out]
                else:
                    run = np.bitwise_xor.accumulate(x)
                    run = run ^ run[start] ^ x[start]
                    run[goes_on] ^= carry[out]
                new[out], carry[out] = run, int(run[-1])
            last = key[-1]
            yield pdf.assign(**new, part=np.full(n, part, np.int32))

    # a range's number depends on the layout: written once, then read by all that follows
    ranged = stored(df.repartitionByRange(by, *order).sortWithinPartitions(by, *order).mapInPandas(scan, schema), name)
    edges = ranged.groupBy("part").agg(F.min(by).alias("low"), F.max(by).alias("high"))
    spread = (edges.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias(by))
              .groupBy(by).agg(F.count("*").alias("parts")).where("parts > 1").select(by))
    # at most two rows a range from here on
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (ranged.join(F.broadcast(spread), by).groupBy(by, "part")
              .agg(*[F.sum(c).alias(c) for c in sums], *[F.bit_xor(c).alias(c) for c in xors]))
    added = stored(totals.select(by, "part", *[F.sum(c).over(before).alias(f"{o}_before") for c, o in sums.items()],
                          *[F.expr(f"bit_xor({c})").over(before).alias(f"{o}_before") for c, o in xors.items()]), f"{name}_offsets")
    zero = F.lit(0).cast("long")
    return (ranged.join(F.broadcast(added), [by, "part"], "left")
            .select(*df.columns, *[(F.col(o) + F.coalesce(f"{o}_before", zero)).alias(o) for o in sums.values()],
                    *[F.col(o).bitwiseXOR(F.coalesce(f"{o}_before", zero)).alias(o) for o in xors.values()]))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, e1, e2, words): turns numbered from 1, as hashes."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().cast("long").alias("has_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.xxhash64(role, text).alias("e1"), F.xxhash64(F.lit(1), text, role).alias("e2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"))
    # finding the ranges reads the rows once more: hashes, not the texts
    done = running(stored(rows, "turn_hashes"), "conv_id", ["has_turn", "turn", "e1", "e2"], {"one": "place"}, {}, "ordered_turns")
    return done.select("conv_id", "place", "e1", "e2", "words")


def spliced(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Each conversation c anew: the first h turns of the first id of its family
    (c - c % family), then its own after the first h; h = crc32(c) % heads.
    Returns its turns (conv_id, depth, of, e1, e2, words; of: its length) and
    (conv_id, of) of all."""
    own = stored(turns.groupBy("conv_id").agg(F.max("place").alias("n"))
                 .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
                 .withColumn("base", F.col("conv_id") - F.col("conv_id") % family), "conversation_lengths")
    base = own.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = (own.join(base, "base", "left")
             .withColumn("b", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
             .select("conv_id", "base", "h", "b", (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))).alias("of")))
    convs = stored(convs, "spliced_lengths")
    first = (turns.where((F.col("place") < heads) & (F.col("conv_id") % family == 0))
             .withColumnRenamed("conv_id", "base"))                  # a few rows a family
    head = (convs.where("h > 0").join(first, "base").where("place <= h")
            .select("conv_id", F.col("place").alias("depth"), "of", "e1", "e2", "words"))
    rest = (turns.join(convs.select("conv_id", "h", "b", "of"), "conv_id").where("place > h")
            .select("conv_id", (F.col("place") - F.col("h") + F.col("b")).alias("depth"), "of", "e1", "e2", "words"))
    return head.unionByName(rest), convs.select("conv_id", "of")


# -- time-forward processing -------------------------------------------------
class SpillingQueue:
    """Priority queue of (key, value) tuples; beyond ``most`` the tuples go as a
    sorted part to an unnamed file of the task, which ends with it."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.parts, self.spilled = most, [], [], 0

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.most:
            file = tempfile.TemporaryFile()
            for one in sorted(self.heap):
                pickle.dump(one, file)
            file.seek(0)
            self.heap, self.spilled = [], self.spilled + 1
            self._next(file)
        heapq.heappush(self.heap, item)

    def _next(self, file) -> None:
        try:
            heapq.heappush(self.parts, (pickle.load(file), id(file), file))
        except EOFError:
            file.close()

    def least(self) -> tuple | None:
        return min(self.heap[:1] + [p[0] for p in self.parts[:1]], default=None)

    def pop(self) -> tuple:
        if self.heap and (not self.parts or self.heap[0] <= self.parts[0][0]):
            return heapq.heappop(self.heap)
        item, _, file = heapq.heappop(self.parts)
        self._next(file)
        return item


RUN = ["shard", "bottom", "conv_id", "members", "top", "spent", "kids", "leaves", "below", "up_conv", "up_here"]
DONE = "conv_id long, members long, leaves long, below long, up_conv long, up_bottom long, up_here boolean, saved long"


def forward(runs: DataFrame, shards: int, queue: int = QUEUE) -> DataFrame:
    """Totals of every run from those below it. ``leaves`` and ``below`` come with
    what is known already (bare paths, other shards); ``spent`` is what the run
    saves itself; ``up_here``: its parent is in the same shard."""
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = SpillingQueue(queue)
        for pdf in batches:
            out = []
            for r in pdf[RUN].itertuples(index=False):
                key = (r.shard, -r.bottom, r.conv_id)
                leaves, below = r.leaves, r.below
                while (least := waiting.least()) is not None and least[:3] <= key:
                    at = waiting.pop()
                    if at[:3] != key:
                        raise AssertionError(f"no run for {at}")
                    leaves, below = leaves + at[3], below + at[4]
                leaves = leaves if r.kids else 1
                if r.up_here:
                    waiting.push((r.shard, 1 - r.top, r.up_conv, leaves, below + r.spent))
                out.append((r.conv_id, r.members, leaves, below, r.up_conv, r.top - 1, r.up_here, below + r.spent))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DONE.split(", ")])
        if waiting.least() is not None:
            raise AssertionError(f"no run for {waiting.least()}")

    return (runs.select(*RUN).repartition(shards, "shard")
            .sortWithinPartitions("shard", F.desc("bottom"), "conv_id").mapInPandas(walk, DONE))


# -- digests of member ids ---------------------------------------------------
def id_digests(ids: DataFrame, keys: list[str], of: str) -> DataFrame:
    """(keys, sha256) of each key's ids (long keys and ids), ascending and comma-joined."""
    cols = ", ".join(f"{c} long" for c in keys)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[keys].to_numpy()
            cuts = np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, len(k)].tolist()
            member = pdf[of].to_numpy()
            yield pd.DataFrame([(*k[a].tolist(), int(member[a]), ",".join(map(str, member[a:b].tolist())))
                                for a, b in zip(cuts, cuts[1:])], columns=[*keys, "low", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sha = None, None
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                key = tuple(r[:len(keys)])
                if key == last:
                    sha.update(b"," + r.ids.encode())
                else:
                    if last is not None:
                        out.append((*last, sha.hexdigest()))
                    last, sha = key, hashlib.sha256(r.ids.encode())
            yield pd.DataFrame(out, columns=[*keys, "sha256"]).astype(dict.fromkeys(keys, "int64"))
        if last is not None:
            yield pd.DataFrame([(*last, sha.hexdigest())], columns=[*keys, "sha256"])

    packed = (ids.select(*keys, of).repartitionByRange(*keys, of).sortWithinPartitions(*keys, of)
              .mapInPandas(pack, f"{cols}, low long, ids string"))
    return (packed.repartition(*keys).sortWithinPartitions(*keys, "low")
            .mapInPandas(digest, f"{cols}, sha256 string"))


# -- the trie ----------------------------------------------------------------
def prefix_trie(turns: DataFrame, lengths: DataFrame, most_members: int | None = None,
                runs_per_shard: int = RUNS_PER_SHARD, queue: int = QUEUE) -> DataFrame:
    """A row a node of the trie of ``turns`` (conv_id, depth, of, e1, e2, words)
    of the conversations ``lengths`` (conv_id, of)."""
    marked = turns.select(
        "conv_id", "depth", "of", "words", F.xxhash64("depth", "e1", "e2").alias("z1"),
        F.xxhash64(F.lit(7), "e2", "depth", "e1").alias("z2"))
    named = running(marked, "conv_id", ["depth"], {"words": "cum"}, {"z1": "k1", "z2": "k2"}, "named_turns")
    zero = F.lit(0).cast("long")
    nodes = named.groupBy("k1", "k2").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("members"),
        F.min("words").alias("words"), F.min("cum").alias("cum"), F.count_if(F.col("depth") == F.col("of")).alias("ends"),
        F.min(F.col("k1").bitwiseXOR(F.col("z1"))).alias("p1"), F.min(F.col("k2").bitwiseXOR(F.col("z2"))).alias("p2"))
    root = (lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("members"),
                        F.count_if(F.col("of") == 0).alias("ends")).where("members > 0")
            .select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id", "members", zero.alias("words"),
                    zero.alias("cum"), "ends", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2")))
    nodes = stored(nodes.unionByName(root), "trie_nodes")
    total = lengths.count()
    heavy_from = min(max(most_members or max(LEAST_MEMBERS, int(total ** 0.5)), 1), max(total - 1, 1))

    before = F.col("cum") - F.col("words")
    bare = nodes.groupBy("conv_id", "members").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("ends").alias("ends"),
        ((F.col("members") - 1) * (F.max("cum") - F.min(before))).alias("spent"), F.max("cum").alias("cum_end"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("up"), F.max_by(F.struct("k1", "k2"), "depth").alias("low"))
    runs = stored(bare.select("conv_id", "members", "top", "bottom", "ends", "spent", "cum_end",
                              F.col("up.p1").alias("p1"), F.col("up.p2").alias("p2"),
                              F.col("low.k1").alias("k1"), F.col("low.k2").alias("k2")), "trie_runs")

    # the parent of a run is the run whose lower end its top hangs on; heavy
    # parents (with any number of children) come by broadcast while they are few
    is_heavy = F.col("members") > heavy_from
    ends_at = runs.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("up_conv"),
                          F.col("members").alias("up_members"))
    heavy_ends = ends_at.where(F.col("up_members") > heavy_from)
    n_heavy = heavy_ends.count()
    few = F.broadcast(heavy_ends) if n_heavy <= 100_000 else heavy_ends
    on_heavy = runs.join(few, ["p1", "p2"], "left")
    linked = on_heavy.where("up_conv is not null or p1 is null").unionByName(
        on_heavy.where("up_conv is null and p1 is not null").drop("up_conv", "up_members")
        .join(ends_at.where(F.col("up_members") <= heavy_from), ["p1", "p2"]))
    linked = stored(linked.select("conv_id", "members", "top", "bottom", "ends", "spent", "cum_end", "k1", "k2",
                                  "up_conv", "up_members"), "trie_links")
    kids = (linked.where("up_conv is not null").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_members").alias("members"))
            .agg(F.count("*").alias("kids"), F.count_if(F.col("members") == 1).alias("bare_kids")))
    work = (linked.where("members > 1 or top = 0").join(kids, ["conv_id", "members"], "left")
            .withColumns({"kids": F.coalesce("kids", zero), "leaves": F.coalesce("bare_kids", zero), "below": zero, "up_conv": F.coalesce("up_conv", zero),
                          "up_here": F.coalesce((F.col("up_members") > heavy_from) == is_heavy, F.lit(False))}))
    work = stored(work, "trie_work")

    # a light run's shard: the first light node on its conversation's path
    heavy_nodes = nodes.where(is_heavy & (F.col("depth") > 0)).select("k1", "k2")
    n_nodes = heavy_nodes.count()
    light_rows = named.select("conv_id", "depth", "k1", "k2")
    if n_nodes:
        some = F.broadcast(heavy_nodes) if n_nodes <= 100_000 else heavy_nodes
        light_rows = light_rows.join(some, ["k1", "k2"], "left_anti")
    tops = light_rows.groupBy("conv_id").agg(F.min_by(F.struct("k1", "k2"), "depth").alias("k"))
    light = work.where(~is_heavy)
    shards = max(1, -(-light.count() // runs_per_shard))
    dealt = light.join(tops, "conv_id").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(3), "k.k1", "k.k2"), F.lit(shards).cast("long")))
    done_light = stored(forward(dealt, shards, queue), "trie_light")

    # across the shards' tops: summed by heavy parent, then the heavy runs
    sent = (done_light.where("not up_here").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_bottom").alias("bottom"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_below")))
    heavy = (work.where(is_heavy).join(sent, ["conv_id", "bottom"], "left")
             .withColumns({"leaves": F.col("leaves") + F.coalesce("more_leaves", zero),
                           "below": F.coalesce("more_below", zero), "shard": zero}))
    totals = (done_light.unionByName(forward(heavy, 1, queue))
              .select("conv_id", "members", "leaves", "below"))

    digests = id_digests(
        named.where(F.col("depth") == F.col("of")).select("k1", "k2", "conv_id")
        .unionByName(lengths.where("of = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")), ["k1", "k2"], "conv_id")
    per_run = (linked.join(totals, ["conv_id", "members"], "left").join(kids, ["conv_id", "members"], "left")
               .join(digests, ["k1", "k2"], "left")
               .select("conv_id", "members", "top", "bottom", "up_conv", "cum_end", "kids",
                       F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves"), F.coalesce("below", zero).alias("below"), "sha256"))
    # one row on the run's side: a long run's nodes may be split over tasks
    at_end = F.col("depth") == F.col("bottom")
    saved = F.col("below") + (F.col("members") - 1) * (F.col("cum_end") - before)
    empty = hashlib.sha256(b"").hexdigest()
    return (nodes.join(per_run, ["conv_id", "members"])
            .select("conv_id", "depth",
                    F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == F.col("top"), F.col("up_conv"))
                    .otherwise(F.col("conv_id")).alias("parent_conv_id"),
                    F.col("members").alias("n_convs"),
                    F.when(at_end, F.coalesce("kids", zero)).otherwise(1).cast("long").alias("n_children"),
                    F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
                    F.when(at_end, F.coalesce("sha256", F.lit(empty))).otherwise(empty).alias("ends_sha256")))


def op11(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt with the heads of their families."""
    turns = ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(*spliced(stored(turns, "turns")))


OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns,
         any_value(CAST(conv_id AS VARCHAR)) AS c
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, conv_id - conv_id % {FAMILY} AS base, {crc32_sql('c')} % {HEADS} AS h FROM own
), paths AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
  FROM heads a LEFT JOIN own b ON b.conv_id = a.base
), nodes AS (
  SELECT path[1:d] AS prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(path) = d), '') AS ends
  FROM (SELECT conv_id, path, unnest(generate_series(0, len(path))) AS d FROM paths) GROUP BY ALL
), kids AS (
  SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), own_part AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children,
         CASE WHEN n.d > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.prefix[-1].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix AND k.d = n.d
), subtrees AS (
  SELECT prefix[1:a] AS prefix, a AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM (SELECT prefix, n_children, saved, unnest(generate_series(0, d)) AS a FROM own_part) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM own_part n JOIN subtrees s ON s.prefix = n.prefix AND s.d = n.d
LEFT JOIN nodes p ON p.prefix = n.prefix[1:n.d - 1] AND p.d = n.d - 1
"""
