"""N-gram Jaccard join with signature trees (operator 4).

Two documents link when the Jaccard similarity of their sets of word shingles
reaches ``percent``; the result is each document's component under links.

1. Sets. One pass over the texts hashes every shingle to 64 bits and keeps, per
   document, the size of its set, a 128-bit digest of it, a token bitmap (one
   parity bit per hash slot) and its bucket keys. Equal sets become one class
   (a partially aggregated group-by), so exact copies cost one row.
2. Roots. A linked pair differs in at most D tokens, D known from the size
   range. Tokens are dealt by hash to D + 1 + e parts, so at least e + 1 parts
   are equal in both; each side leaves out its e lightest parts (fewest
   tokens), and the heaviest equal part is left out by neither. Each remaining
   part is a bucket key, in the set's own size class and in every larger one in
   which a partner may lie: linked classes always share one, whatever the data
   and the threshold, and classes in no common bucket cannot reach the overlap. Keys are counted
   by a two-step radix exchange of packed arrays: a task first merges its own,
   so a key held by a third of the rows sends one entry per task.
3. Star links. In each bucket every class is compared with the smallest one;
   pairs that the bitmaps allow are verified on whole sets; components are
   found by iterated minimum-label contraction. Large groups of near copies
   melt into one component here with one pair per member.
4. Signature trees. Buckets that still hold several components are cut into
   blocks of at most BLOCK classes (pairs of blocks for larger buckets). Per
   block a tree is built whose nodes hold OR- and AND-combined bitmaps and a
   size range; a dual traversal drops node pairs whose maximum possible
   overlap misses the threshold or that lie in one component, and compares the
   rest leaf by leaf. Pairs left over travel as packed arrays to the pair of
   homes of their classes (a home: classes with one smallest bucket mate, in
   parts of about HOME), where the whole sets arrive once and decide; a task
   returns links that join components, not all pairs. No link between different
   components is lost.

Defined cases: null text or text without words has an empty set and links with
nothing; with fewer than ``size`` words the whole sequence is the one shingle;
rows with equal doc_id are separate rows; a null doc_id takes part but never
names a component unless all its members' ids are null; an empty table gives an
empty result; other columns are ignored here and kept by :func:`drop_near_copies`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import (
    WordHashes,
    join_few,
    mix,
    packed,
    shuffle_partitions,
    stored,
    table,
    unpacked,
    window_hashes,
    words,
)

_LOW48 = np.uint64((1 << 48) - 1)
LOW48 = (1 << 48) - 1
#: Size classes: each spans sizes up to RATIO times its least.
RATIO = 1.4
#: Parts left out, as a share of the largest difference of a linked pair.
SPARE = 0.3
#: Most classes in a block that one tree holds; classes in a leaf; children of a node.
BLOCK, LEAF, FANOUT = 1024, 32, 8
#: Classes in a part of a home; bytes of a bit matrix over a task's own tokens.
HOME, MATRIX_BYTES = 512, 32 << 20
#: Bucket entries that one task of the exchange holds, about, and that a task
#: merges at a time before it.
ENTRIES_A_TASK, ENTRIES_AT_ONCE = 1_000_000, 500_000
ROWS_A_TASK = 100_000


def size_class(n: int) -> tuple[int, int]:
    """(index, largest size) of the size class of n."""
    low, index = 1, 0
    while True:
        high = max(low, int(low * RATIO))
        if n <= high:
            return index, high
        low, index = high + 1, index + 1


def shingles(text: str | None, size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    h = memo.of(words(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                if text else [])
    if 0 < len(h) < size:
        return window_hashes(h, len(h)) ^ np.uint64(len(h))
    return np.unique(window_hashes(h, size))


def bitmap_width(n: int) -> int:
    return 1 << min(14, max(8, int(2 * n - 1).bit_length()))


def bitmap(s: np.ndarray, width: int) -> np.ndarray:
    slots = (mix(s ^ np.uint64(77)) & np.uint64(width - 1)).view(np.int64)
    return np.packbits((np.bincount(slots, minlength=width) & 1).astype(np.uint8))


def fold(bits: bytes, width_bytes: int) -> np.ndarray:
    """The bitmap as if made with fewer slots."""
    a = np.frombuffer(bits, np.uint8)
    return np.bitwise_xor.reduce(a.reshape(-1, width_bytes), axis=0) if len(a) > width_bytes else a


def part_keys(s: np.ndarray, index: int, high: int, percent: int) -> np.ndarray:
    """48-bit bucket keys of a set within one size class."""
    most = 2 * high * (100 - percent) // (100 + percent)    # tokens a linked pair can differ in
    if most == 0:
        return s[:0]                                        # only equal sets link
    spare = max(1, int(most * SPARE))
    parts = most + 1 + spare
    at = (mix(s ^ np.uint64(12345)) % np.uint64(parts)).view(np.int64)
    content = np.zeros(parts, dtype=np.uint64)
    np.add.at(content, at, mix(s))
    tokens = np.bincount(at, minlength=parts)
    chosen = np.lexsort((content, tokens))[spare:]
    return mix(content[chosen] + chosen.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
               + np.uint64(index * 0xD1342543DE82EF95 % 2**64) + tokens[chosen].astype(np.uint64)) & _LOW48


def bucket_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys in the set's own size class and in every larger one in which a
    partner may lie."""
    n = len(s)
    if n == 0:
        return s
    index, high = size_class(n)
    keys = [part_keys(s, index, high, percent)]
    while 100 * n >= percent * (high + 1):
        index, high = size_class(high + 1)
        keys.append(part_keys(s, index, high, percent))
    return np.concatenate(keys)


def six_bytes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6]


def from_six(b) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.view(np.uint64).ravel()


def row_key(docs: DataFrame) -> DataFrame:
    """k1, k2: a 128-bit key of a row's id and text, also where the id is null."""
    return (docs.withColumn("k1", F.xxhash64("doc_id", "text"))
            .withColumn("k2", F.xxhash64(F.lit(1), "doc_id", "text")))


def set_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    def run(batches):
        memo = WordHashes()
        for batch in batches:
            n, d1, d2, bits, keys = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, size, memo)
                n.append(len(s))
                d1.append(int(mix(s).sum(dtype=np.uint64)) - (1 << 63))
                d2.append(int(mix(s ^ np.uint64(999)).sum(dtype=np.uint64)) - (1 << 63))
                bits.append(bitmap(s, bitmap_width(len(s))).tobytes() if len(s) else b"")
                keys.append(six_bytes(bucket_keys(s, percent)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
                 pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bits, pa.binary()), pa.array(keys, pa.binary())],
                names=["rid", "doc_id", "k1", "k2", "n", "d1", "d2", "bits", "keys"])

    return (row_key(docs.select("doc_id", "text")).withColumn("rid", F.monotonically_increasing_id())
            .select("rid", "doc_id", "k1", "k2", "text")
            .mapInArrow(run, "rid long, doc_id long, k1 long, k2 long, n long, d1 long, d2 long,"
                             " bits binary, keys binary"))


def shared_buckets(sets: DataFrame, parts: int) -> DataFrame:
    """(key, d) of the buckets with two classes or more; d: 48 bits of the digest."""
    def pack(p, key, d):
        if not len(p):
            return [], []
        order = np.argsort(p, kind="stable")
        p, both = p[order], np.concatenate([six_bytes(key[order]), six_bytes(d[order])], axis=1)
        cut = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        return p[cut].tolist(), [x.tobytes() for x in np.split(both, cut[1:])]

    def slices(batch):
        """(keys, d) of runs of rows with about ENTRIES_AT_ONCE keys."""
        blobs = batch.column("keys").to_pylist()
        d1 = batch.column("d1").to_numpy(zero_copy_only=False).view(np.uint64) & _LOW48
        sizes = np.array([len(b) // 6 for b in blobs], dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // ENTRIES_AT_ONCE
        for k in np.unique(part[sizes > 0]):
            at = np.flatnonzero(part == k)
            yield from_six(b"".join(blobs[i] for i in at)), np.repeat(d1[at], sizes[at])

    def deal(batches):
        for key, d in (x for batch in batches for x in slices(batch)):
            order = np.lexsort((d, key))
            key, d = key[order], d[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (d[1:] != d[:-1])]    # copies in this slice
            key, d = key[new], d[new]
            first = np.r_[True, key[1:] != key[:-1]]
            inner = ~first | np.r_[~first[1:], False]                       # shared within this slice
            p1, b1 = pack((key[first] % np.uint64(parts)).view(np.int64), key[first], d[first])
            spread = np.uint64(int(d[0]) % parts)
            p2, b2 = pack(((np.arange(inner.sum(), dtype=np.uint64) // np.uint64(50_000) + spread)
                           % np.uint64(parts)).view(np.int64) + parts, key[inner], d[inner])
            yield pa.RecordBatch.from_arrays([pa.array(p1 + p2, pa.int64()), pa.array(b1 + b2, pa.binary())],
                                             names=["p", "entries"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(pdf["entries"]), np.uint8).reshape(-1, 12)
        key, d = from_six(np.ascontiguousarray(raw[:, :6])), from_six(np.ascontiguousarray(raw[:, 6:]))
        if pdf["p"].iloc[0] < parts:
            order = np.lexsort((d, key))
            key, d = key[order], d[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (d[1:] != d[:-1])]
            key, d = key[new], d[new]
            same = key[1:] == key[:-1]
            many = np.r_[same, False] | np.r_[False, same]
            key, d = key[many], d[many]
        return pd.DataFrame({"key": key.view(np.int64), "d": d.view(np.int64)})

    return (sets.select("d1", "keys").mapInArrow(deal, "p long, entries binary")
            .groupBy("p").applyInPandas(meet, "key long, d long"))


def _enough(x, y, differ, percent: int):
    """Whether sets of sizes x and y that differ in so many tokens reach the similarity."""
    return (100 - percent) * (x + y) >= (100 + percent) * differ


def bitmap_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow the similarity."""
    c = classes.select("node", "n", "bits")

    def run(batches):
        for batch in batches:
            x, y = batch.column("n").to_pylist(), batch.column("m").to_pylist()
            ok = []
            for n, m, p, q in zip(x, y, batch.column("bits").to_pylist(), batch.column("other").to_pylist()):
                w = min(len(p), len(q))
                ok.append(_enough(n, m, int(np.bitwise_count(fold(p, w) ^ fold(q, w)).sum()), percent))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])

    return (pairs.join(c.withColumnRenamed("node", "a"), "a")
            .join(c.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("other")), "b")
            .where((100 * F.least("n", "m")) >= percent * F.greatest("n", "m"))
            .select("a", "b", "n", "m", "bits", "other").mapInArrow(run, "a long, b long"))


def class_tokens(nodes: DataFrame, n_nodes: int, sets: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, tokens) of the given classes: whole sets, from one pass over the texts."""
    nodes = stored(nodes.withColumnRenamed("node", "rid").join(sets.select("rid", "k1", "k2"), "rid"), "set_nodes")

    def tokens(batches):
        memo = WordHashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array([shingles(t, size, memo).tobytes()
                                                for t in batch.column("text").to_pylist()], pa.binary())],
                names=["node", "tokens"])

    texts = join_few(row_key(docs.select("doc_id", "text")).select("k1", "k2", "text"), nodes, ["k1", "k2"], n_nodes)
    # repeated rows of one id and text give the same set: any one will do
    return stored(texts.select("rid", "text").mapInArrow(tokens, "node long, tokens binary"),
                  "token_sets").dropDuplicates(["node"])


def verified(pairs: DataFrame, n_pairs: int, sets: DataFrame, docs: DataFrame, size: int,
             percent: int) -> DataFrame:
    """The pairs that link, by the whole sets of both texts."""
    token_sets = class_tokens(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * n_pairs,
                              sets, docs, size)

    def compare(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            out = []
            for i, (p, q) in enumerate(zip(batch.column("tokens").to_pylist(), batch.column("other").to_pylist())):
                x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in out], pa.int64()),
                                              pa.array([b[i] for i in out], pa.int64())], names=["a", "b"])

    return (pairs.join(token_sets.withColumnRenamed("node", "a"), "a")
            .join(token_sets.select(F.col("node").alias("b"), F.col("tokens").alias("other")), "b")
            .select("a", "b", "tokens", "other").mapInArrow(compare, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of the edges; comp: the least node reachable.
    Each round hooks every component to its least neighbour, halves the chains
    twice and renames; components only ever shrink, so it ends."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stored(ends.select("node", F.col("node").alias("comp")), "labels")
    while True:
        left = labels.select(F.col("node").alias("a"), F.col("comp").alias("x"))
        right = labels.select(F.col("node").alias("b"), F.col("comp").alias("y"))
        open_edges = edges.join(left, "a").join(right, "b").where("x != y")
        hook = stored(open_edges.select(F.greatest("x", "y").alias("comp"), F.least("x", "y").alias("to"))
                      .groupBy("comp").agg(F.min("to").alias("to")), "hooks")
        if hook.isEmpty():
            return labels
        for _ in range(2):
            further = hook.select(F.col("comp").alias("to"), F.col("to").alias("further"))
            hook = hook.join(further, "to", "left").select("comp", F.coalesce("further", "to").alias("to"))
        labels = stored(labels.join(hook, "comp", "left")
                        .select("node", F.coalesce("to", "comp").alias("comp")), "labels")


class _Tree:
    """Signature tree over the classes of one block, by size, then bitmap."""

    def __init__(self, n, bits, comp):
        order = np.lexsort((*bits.T[:8], n))
        self.order, self.n, self.bits, self.comp = order, n[order], bits[order], comp[order]
        start = np.arange(0, len(n), LEAF)
        level = [self._node(self.n, self.n, self.bits, self.bits, self.comp, self.comp, start)]
        while len(level[-1][0]) > 1:
            lo, hi, any_, all_, cmin, cmax = level[-1]
            level.append(self._node(lo, hi, any_, all_, cmin, cmax, np.arange(0, len(lo), FANOUT)))
        self.levels = level

    @staticmethod
    def _node(lo, hi, any_, all_, cmin, cmax, start):
        return (np.minimum.reduceat(lo, start), np.maximum.reduceat(hi, start),
                np.bitwise_or.reduceat(any_, start, axis=0), np.bitwise_and.reduceat(all_, start, axis=0),
                np.minimum.reduceat(cmin, start), np.maximum.reduceat(cmax, start))

    def leaf(self, i):
        return slice(i * LEAF, (i + 1) * LEAF)


def dual_traversal(s: _Tree, t: _Tree, percent: int, same: bool):
    """Positions (in s, in t) of the pairs of different components that may link."""
    found = []
    ds, dt = len(s.levels) - 1, len(t.levels) - 1
    stack = [(ds, 0, dt, 0)]
    while stack:
        ds, i, dt, j = stack.pop()
        lo, hi, any_, all_, cmin, cmax = (x[i] for x in s.levels[ds])
        lo2, hi2, any2, all2, cmin2, cmax2 = (x[j] for x in t.levels[dt])
        if cmin == cmax == cmin2 == cmax2:
            continue
        differ = int(np.bitwise_count(all_ & ~any2).sum()) + int(np.bitwise_count(all2 & ~any_).sum())
        if not _enough(hi, hi2, max(differ, lo2 - hi, lo - hi2), percent):
            continue
        if ds == dt == 0:
            p, q = s.leaf(i), t.leaf(j)
            differ = np.bitwise_count(s.bits[p][:, None, :] ^ t.bits[q][None, :, :]).sum(axis=2, dtype=np.int64)
            differ = np.maximum(differ, abs(s.n[p][:, None] - t.n[q][None, :]))
            ok = _enough(s.n[p][:, None], t.n[q][None, :], differ, percent)
            ok &= s.comp[p][:, None] != t.comp[q][None, :]
            if same and i == j:
                ok &= np.triu(np.ones(ok.shape, bool), 1)
            x, y = np.nonzero(ok)
            found.append(np.stack([s.order[x + p.start], t.order[y + q.start]], axis=1))
        elif ds >= dt:
            kids = range(i * FANOUT, min((i + 1) * FANOUT, len(s.levels[ds - 1][0])))
            if same and ds == dt:
                # both sides open at once; each unordered pair of children once
                others = range(j * FANOUT, min((j + 1) * FANOUT, len(t.levels[dt - 1][0])))
                stack += [(ds - 1, x, dt - 1, y) for x in kids for y in others if x <= y]
            else:
                stack += [(ds - 1, x, dt, j) for x in kids]
        else:
            stack += [(ds, i, dt - 1, y)
                      for y in range(j * FANOUT, min((j + 1) * FANOUT, len(t.levels[dt - 1][0])))]
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def block_pairs(side, node, n, bits, comp, percent: int) -> np.ndarray:
    """Pairs of nodes of one block (side all 0) or between two (sides 0 and 1)."""
    width = min(map(len, bits))
    bits = np.stack([fold(b, width) for b in bits]).view(np.uint64)
    trees = []
    for k in np.unique(side):
        own = np.flatnonzero(side == k)
        trees.append((own, _Tree(n[own], bits[own], comp[own])))
    if len(trees) == 1:
        own, tree = trees[0]
        at = dual_traversal(tree, tree, percent, True)
        return np.sort(node[own][at], axis=1)
    (own, tree), (own2, tree2) = trees
    at = dual_traversal(tree, tree2, percent, False)
    return np.sort(np.stack([node[own][at[:, 0]], node[own2][at[:, 1]]], axis=1), axis=1)


def homes(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """(node, home, part): classes with the same smallest bucket mate live
    together, in parts of about HOME."""
    home = (members.join(pivots.select("key", "a"), "key").groupBy("node").agg(F.min("a").alias("home")))
    sizes = home.groupBy("home").agg(F.count("*").alias("size"))
    return (home.join(sizes, "home")
            .select("node", "home", F.pmod(F.xxhash64("node"), F.expr(f"size div {HOME} + 1")).alias("part")))


def tree_pairs(members: DataFrame, classes: DataFrame, labels: DataFrame, lives: DataFrame,
               percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and may link, as one
    row per pair of homes: ``pairs`` (packed, distinct) and ``nodes`` in them."""
    now = (members.join(labels, "node", "left")
           .select("key", "node", F.coalesce("comp", "node").alias("comp")))
    mixed = (now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                    F.count("*").alias("size")).where("low != high").select("key", "size"))
    blocks = F.expr(f"(size + {BLOCK - 1}) div {BLOCK}")
    rows = (now.join(mixed, "key").withColumn("blocks", blocks)
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
            .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                    # inside a pair of blocks: which of the two; a block with itself: 0
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "comp"))
    rows = stored(rows, "tree_rows")
    parts = max(shuffle_partitions(members.sparkSession), -(-rows.count() // ROWS_A_TASK))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "x", "y"], kind="stable")
        key = pdf[["key", "x", "y"]].to_numpy()
        cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        ends = np.r_[cut[1:], len(pdf)]
        side, node, n, comp = (pdf[c].to_numpy() for c in ("side", "node", "n", "comp"))
        bits, found = pdf["bits"].to_numpy(), [np.zeros((0, 2), dtype=np.int64)]
        for i, j in zip(cut, ends):
            if j - i > 1 and (comp[i:j] != comp[i]).any():
                found.append(block_pairs(side[i:j], node[i:j], n[i:j], bits[i:j], comp[i:j], percent))
        pairs = np.unique(np.concatenate(found), axis=0)
        place = dict(zip(node.tolist(), zip(pdf["home"].tolist(), pdf["part"].tolist())))
        by = {}
        for k, (a, b) in enumerate(pairs.tolist()):
            by.setdefault(tuple(sorted((place[a], place[b]))), []).append(k)
        return pd.DataFrame([(*p, *q, pairs[k].tobytes()) for (p, q), k in by.items()],
                            columns=["h1", "p1", "h2", "p2", "pairs"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = np.unique(np.frombuffer(b"".join(pdf["pairs"]), np.int64).reshape(-1, 2), axis=0)
        return pd.DataFrame({**{c: pdf[c].iloc[:1] for c in ("h1", "p1", "h2", "p2")},
                             "pairs": [pairs.tobytes()], "nodes": [np.unique(pairs).tolist()]})

    return (rows.join(classes.select("node", "n", "bits"), "node").join(lives, "node")
            .withColumn("p", F.pmod(F.xxhash64("key", "x", "y"), F.lit(parts)))
            .groupBy("p").applyInPandas(run, "h1 long, p1 long, h2 long, p2 long, pairs binary")
            .groupBy("h1", "p1", "h2", "p2")
            .applyInPandas(merge, "h1 long, p1 long, h2 long, p2 long, pairs binary, nodes array<long>"))


def overlaps(pairs: np.ndarray, tokens: list[np.ndarray]) -> np.ndarray:
    """Common tokens of each pair (places in ``tokens``): rows of a bit matrix over
    the tokens at hand, or pair by pair where that would be too large."""
    names, at = np.unique(np.concatenate(tokens), return_inverse=True)
    width = -(-len(names) // 64) * 8
    if width * len(tokens) > MATRIX_BYTES:
        return np.array([len(np.intersect1d(tokens[a], tokens[b], assume_unique=True)) for a, b in pairs.tolist()])
    matrix, start = np.zeros((len(tokens), width), dtype=np.uint8), 0
    for k, t in enumerate(tokens):
        own = np.zeros(width * 8, dtype=np.uint8)
        own[at[start:start + len(t)]] = 1
        matrix[k] = np.packbits(own)
        start += len(t)
    matrix = matrix.view(np.uint64)
    step = max(1, (8 << 20) // width)
    return np.concatenate([np.bitwise_count(matrix[p[:, 0]] & matrix[p[:, 1]]).sum(axis=1, dtype=np.int64)
                           for p in (pairs[i:i + step] for i in range(0, len(pairs), step))])


def joining_links(pairs: np.ndarray, comp: list[int]) -> list[int]:
    """Which of the links (places) are needed to join their components."""
    root = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    kept = []
    for k, (a, b) in enumerate(pairs.tolist()):
        x, y = find(comp[a]), find(comp[b])
        if x != y:
            root[x] = y
            kept.append(k)
    return kept


def tree_links(found: DataFrame, labels: DataFrame, sets: DataFrame, docs: DataFrame, size: int,
               percent: int) -> DataFrame:
    """Links (a, b) among the pairs of :func:`tree_pairs` that join components."""
    where = ["h1", "p1", "h2", "p2"]
    needed = stored(found.select(*where, F.explode("nodes").alias("node")), "tree_nodes")
    nodes = needed.select("node").distinct()
    token_sets = class_tokens(nodes, needed.count(), sets, docs, size)
    there = (needed.join(token_sets, "node").join(labels, "node", "left")
             .select(*where, "node", F.coalesce("comp", "node").alias("comp"), "tokens"))

    def decide(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        right = right.sort_values("node", kind="stable")
        node = right["node"].to_numpy()
        tokens = [np.frombuffer(t, np.uint64) for t in right["tokens"]]
        pairs = np.searchsorted(node, np.frombuffer(left["pairs"].iloc[0], np.int64).reshape(-1, 2))
        n = np.array([len(t) for t in tokens])
        both, total = overlaps(pairs, tokens), n[pairs[:, 0]] + n[pairs[:, 1]]
        links = pairs[100 * both >= percent * (total - both)]
        links = node[links[joining_links(links, right["comp"].tolist())]].reshape(-1, 2)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})

    return (found.select(*where, "pairs").groupBy(*where)
            .cogroup(there.groupBy(*where)).applyInPandas(decide, "a long, b long"))


def near_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(rid, doc_id, k1, k2, n_shingles, component_id, first): ``first`` marks the
    one row of a component that stays when near copies are dropped."""
    spark = docs.sparkSession
    sets = stored(set_rows(docs, size, percent), "sets")
    classes = stored(sets.where("n > 0").groupBy("d1", "d2")
                     .agg(F.min("rid").alias("node"), F.min("doc_id").alias("least"),
                          F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("head"),
                          F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")
    entries = sets.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-entries // (6 * ENTRIES_A_TASK)))
    members = stored(shared_buckets(sets, parts)
                     .join(classes.select(F.col("d1").bitwiseAND(F.lit(LOW48)).alias("d"), "node"), "d")
                     .select("key", "node").distinct(), "members")

    pivots = (members.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size"))
              .where("size > 1").select("key", "a"))
    star = (members.withColumnRenamed("node", "b").join(pivots, "key").where("a != b")
            .select("a", "b").distinct())
    star = stored(bitmap_pairs(star, classes, percent), "star_pairs")
    links = stored(verified(star, star.count(), sets, docs, size, percent), "star_links")
    labels = components(links)

    found = stored(tree_pairs(members, classes, labels, homes(members, pivots), percent), "tree_pairs")
    if not found.isEmpty():
        new = stored(tree_links(found, labels, sets, docs, size, percent), "tree_links")
        if not new.isEmpty():
            labels = components(links.union(new))

    named = classes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    heads = named.groupBy("comp").agg(F.min("least").alias("component_id"), F.min("head").alias("head"))
    found = (named.select("d1", "d2", "comp").join(heads, "comp")
             .select("d1", "d2", "component_id", F.col("head.rid").alias("head")))
    with_words = (sets.where("n > 0").drop("bits", "keys").join(found, ["d1", "d2"])
                  .select("rid", "doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id",
                          (F.col("rid") == F.col("head")).alias("first")))
    without = (sets.where("n = 0")
               .select("rid", "doc_id", "k1", "k2", F.col("n").alias("n_shingles"),
                       F.col("doc_id").alias("component_id"), F.lit(True).alias("first")))
    return with_words.union(without)


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the least doc_id."""
    stay = (near_components(docs, size, percent).where("first")
            .groupBy("k1", "k2").agg(F.count("*").alias("copies")))
    # rows that are equal in id and text share their key: as many stay as were marked
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    done = (row_key(packed(docs)).join(stay, ["k1", "k2"])
            .withColumn("nth", nth).where("nth <= copies"))
    return unpacked(done, docs.columns)


def op4(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 3-word shingles, 90 percent."""
    docs = table(spark, sf_dir, "documents")
    return near_components(docs, 3, 90).select("doc_id", "n_shingles", "component_id")
