"""Exact top-k by inner product with KD-trees per shard (operator 2).

Vectors are scaled to whole numbers, dealt by hash to shards of about
``per_shard`` vectors, and each shard builds one tree: median splits along the
widest side, tight bounding boxes, and the least id of every node. The score a
box can reach with a query is the sum over components of the better product
with its two sides. Traversal is best first: the node with the highest bound is
opened next, and a query is done when no bound beats its k-th score (ties go to
the smaller id, so a bound equal to it counts only if the node holds a smaller
id).

The k-th score is propagated. A first round searches one shard for each block
of about ``per_block`` queries. Its k-th scores then meet the boxes of all
roots, packed ``ROOTS`` to a row, and only pairs of a query and a shard whose
root can still beat it go on. In the second round a shard's tree is sent once
for every ``BATCH`` blocks, and of a block only the queries that go there.

Scores are exact: products are summed in float64 where they stay below 2**53,
else in integers.

Defined cases: vectors that are null, hold null or non-finite components, or
have no id take no part; rows that share an id, or an id and a vector, are rows
of their own, as queries and as candidates; vectors of different lengths are
not compared; a component or a returned score beyond a long fails with an error,
nothing is cut; fewer than k other vectors give as many rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import stored, table

SCALE = 1024
K, PER_SHARD, PER_BLOCK, LEAF = 10, 4096, 512, 128
#: Roots in a row of boxes; blocks of queries that meet one copy of a tree.
ROOTS, BATCH = 1024, 64


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(rid, id, v, dim) with whole components, one row a row."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    beyond = F.raise_error(F.lit("a component is beyond a long after scaling")).cast("long")
    whole = F.transform(x, lambda c: F.when(F.abs(c * SCALE) < float(1 << 63), F.floor(c * SCALE).cast("long"))
                        .otherwise(beyond))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(F.coalesce(fine, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"), whole.alias("v"))
            .withColumn("dim", F.size("v")))


def largest(rows: np.ndarray) -> int:
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


LOW, HIGH = -(1 << 63), (1 << 63) - 1


def products(rows: np.ndarray, queries: np.ndarray, most: int, bounds: bool = False) -> np.ndarray:
    """rows @ queries as longs, exact; ``most``: the largest component of rows.
    Beyond a long, bounds stop at its ends (they stay bounds), scores are an error."""
    top = largest(queries) * most * max(1, rows.shape[1])
    if top < 1 << 52:
        return (rows.astype(np.float64) @ queries.astype(np.float64)).astype(np.int64)
    if top < 1 << 62:
        return rows @ queries
    out = rows.astype(object) @ queries.astype(object)
    if not bounds and out.size and not LOW <= out.min() <= out.max() <= HIGH:
        raise OverflowError("a score is beyond a long")
    return np.clip(out, LOW, HIGH).astype(np.int64)


class KDTree:
    """Nodes as arrays: box sides, row range, least id and children (or -1)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF, rids: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        lo, hi, start, end, least, kids = [], [], [], [], [], []

        def add(a, b):
            part = rows[order[a:b]]
            lo.append(part.min(axis=0)), hi.append(part.max(axis=0))
            start.append(a), end.append(b), least.append(ids[order[a:b]].min()), kids.append((-1, -1))
            return len(start) - 1

        stack = [add(0, len(ids))]
        while stack:
            node = stack.pop()
            a, b = start[node], end[node]
            if b - a <= leaf or not rows.shape[1]:
                continue
            side = int(np.argmax(hi[node] - lo[node]))
            mid = (b - a) // 2
            part = order[a:b]
            # by component, then id: equal points split into ranges of ids
            part = part[np.lexsort((ids[part], rows[part, side]))]
            order[a:b] = part
            kids[node] = (add(a, a + mid), add(a + mid, b))
            stack += kids[node]
        self.ids, self.rows = ids[order], rows[order]
        self.rids = (ids if rids is None else rids)[order]
        self.lo, self.hi, self.start, self.end = np.array(lo), np.array(hi), start, end
        self.least, self.kids = np.array(least), kids
        self.most = largest(rows)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best (score, -id), k at most, that may matter; ``own``: the row that
        asks; ``floor``: a score that the k-th is known to reach."""
        bounds = self.bounds(query)
        best: list[tuple[int, int]] = []                       # heap: worst first
        heap = [(-int(bounds[0]), int(self.least[0]), 0)]
        while heap:
            bound, least, node = heapq.heappop(heap)
            bound = -bound
            if floor is not None and bound < floor:
                break
            if len(best) == k and (bound, -least) < best[0]:
                # a later node with this bound holds greater ids or a lower bound
                break
            left, right = self.kids[node]
            if left >= 0:
                for kid in (left, right):
                    heapq.heappush(heap, (-int(bounds[kid]), int(self.least[kid]), kid))
                continue
            a, b = self.start[node], self.end[node]
            rows, ids = self.rows[a:b], self.ids[a:b]
            if not (others := self.rids[a:b] != own).all():
                rows, ids = rows[others], ids[others]
            scores = self.products(rows, query)
            use = np.ones(len(ids), bool)
            if floor is not None:
                use &= scores >= floor
            if len(best) == k:
                use &= scores >= best[0][0]
            at = np.flatnonzero(use)
            if len(at) > k:
                at = at[np.lexsort((ids[at], -scores[at]))[:k]]
            for i in at.tolist():
                item = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return best

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Highest score that each node's box can reach."""
        return root_bounds(self.lo, self.hi, query[None, :], self.most)[0]

    def products(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        return products(rows, query, self.most)


def root_bounds(lo: np.ndarray, hi: np.ndarray, queries: np.ndarray, most: int) -> np.ndarray:
    """(queries, boxes): the highest score that each box can reach."""
    sides = np.concatenate([hi, lo], axis=1)
    signs = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    return products(sides, signs.T, most, bounds=True).T


def _tasks(ids, n: int):
    return F.pmod(F.xxhash64(F.lit(7), ids), F.lit(n))


def top_k(vectors: DataFrame, queries, k: int = K, per_shard: int = PER_SHARD, per_block: int = PER_BLOCK,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); ``queries``: condition on ``id``."""
    whole = stored(whole_vectors(vectors, id_col, vec_col), "whole_vectors")
    asked = whole.where(queries)
    n, m = whole.count(), asked.count()
    shards, blocks = max(1, -(-n // per_shard)), max(1, -(-m // per_block))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "rid"])
        tree = KDTree(pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.int64), rids=pdf["rid"].to_numpy())
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "tree": [pickle.dumps(tree)],
                             "lo": [tree.lo[0].astype(np.int64).tobytes()], "hi": [tree.hi[0].astype(np.int64).tobytes()]})

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "rid"])
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "block": [pdf["block"].iloc[0]],
                             "ids": [pdf["id"].tolist()], "at": [np.arange(len(pdf), dtype=np.int64).tobytes()],
                             "rids": [pdf["rid"].to_numpy().tobytes()],
                             "rows": [np.stack(pdf["v"].to_numpy()).astype(np.int64).tobytes()]})

    trees = stored(whole.withColumn("shard", _tasks("rid", shards)).groupBy("dim", "shard")
                   .applyInPandas(build, "dim int, shard long, tree binary, lo binary, hi binary"), "trees")
    # blocks of another length are other blocks
    block = F.pmod(F.xxhash64(F.lit(8), "rid"), F.lit(blocks)) + F.col("dim").cast("long") * blocks
    held = stored(asked.withColumn("block", block).groupBy("dim", "block").applyInPandas(
        gather, "dim int, block long, ids array<long>, at binary, rids binary, rows binary"), "query_blocks")
    found = "block long, place long, vec_id long, score long"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """One tree and up to BATCH blocks of queries (``at``: which of a block, ``floors``: their k-th scores)."""
        out = []
        if len(left) and len(right):
            tree = pickle.loads(left["tree"].iloc[0])
            for r in right.itertuples():
                at = np.frombuffer(r.at, np.int64)
                rids = np.frombuffer(r.rids, np.int64)
                rows = np.frombuffer(r.rows, np.int64).reshape(len(at), r.dim)
                floors = np.frombuffer(r.floors, np.int64) if r.floors else None
                for i in range(len(at)):
                    best = tree.search(rows[i], int(rids[i]), k, None if floors is None else int(floors[i]))
                    out += [(r.block, int(at[i]), -j, s) for s, j in best]
        return pd.DataFrame(out, columns=["block", "place", "vec_id", "score"]).astype("int64")

    def searched(work: DataFrame) -> DataFrame:
        """``work``: (dim, shard, block, at, rids, rows, floors)."""
        dealt = work.withColumn("batch", F.expr(f"block div {BATCH}"))
        where = ["dim", "shard", "batch"]
        copies = dealt.select(*[F.col(c).alias(c) for c in where]).distinct().join(trees.select("dim", "shard", "tree"), ["dim", "shard"])
        return copies.groupBy(*where).cogroup(dealt.groupBy(*where)).applyInPandas(search, found)

    # round one: each block in one shard of its length
    lists = trees.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))     # ids of shards only
    seed = F.expr("shards[cast(pmod(block, size(shards)) as int)]")
    first_work = held.join(lists, "dim").withColumn("shard", seed)
    first = stored(searched(first_work.select("dim", "shard", "block", "at", "rids", "rows",
                                              F.lit(None).cast("binary").alias("floors"))), "first_round")

    # k-th scores against the boxes of all roots
    kth = (first.groupBy("block", "place").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k)
           .groupBy("block").agg(F.collect_list(F.struct("place", "least")).alias("kth")))       # per_block entries
    boxes = (trees.select("dim", "shard", "lo", "hi")
             .withColumn("group", F.expr(f"shard div {ROOTS}")).groupBy("dim", "group")
             .agg(F.collect_list(F.struct("shard", "lo", "hi")).alias("roots")))                 # ROOTS entries
    meet = (held.join(kth, "block", "left").join(first_work.select("dim", "block", F.col("shard").alias("seed")), ["dim", "block"])
            .join(boxes, "dim"))

    def prune(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                rids = np.frombuffer(r.rids, np.int64)
                rows = np.frombuffer(r.rows, np.int64).reshape(len(rids), r.dim)
                floor, known = np.full(len(rids), LOW, np.int64), np.zeros(len(rids), bool)
                for x in r.kth if r.kth is not None else ():
                    floor[x["place"]], known[x["place"]] = x["least"], True
                lo, hi = (np.stack([np.frombuffer(x[c], np.int64) for x in r.roots]) for c in ("lo", "hi"))
                bounds = root_bounds(lo, hi, rows, max(largest(lo), largest(hi)))
                goes = ~known[:, None] | (bounds >= floor[:, None])
                for j, x in enumerate(r.roots):
                    at = np.flatnonzero(goes[:, j])
                    if len(at) and x["shard"] != r.seed:
                        out.append((r.dim, x["shard"], r.block, at.astype(np.int64).tobytes(), rids[at].tobytes(),
                                    rows[at].tobytes(), floor[at].tobytes()))
            yield pd.DataFrame(out, columns=["dim", "shard", "block", "at", "rids", "rows", "floors"])

    goes_on = meet.mapInPandas(prune, "dim int, shard long, block long, at binary, rids binary, rows binary, floors binary")
    second = searched(stored(goes_on, "second_round"))
    ranked = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    best = (first.unionByName(second).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
    names = held.select("block", F.posexplode("ids").alias("place", "query_id"))
    return (best.join(names.withColumn("place", F.col("place").cast("long")), ["block", "place"])
            .select("query_id", "rank", "vec_id", "score"))


def op2(spark, sf_dir: str) -> DataFrame:
    """The 10 best other vectors of every hundredth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


OP2_SQL = """
WITH vecs AS (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN generate_series(1, len(q.v))]) AS BIGINT) AS score
  FROM vecs q JOIN vecs c ON q.rid != c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
