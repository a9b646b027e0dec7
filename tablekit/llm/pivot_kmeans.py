"""Centroid clustering with Ptolemaic pivots (operator 13).

Vectors become whole numbers and are written once with their distances to a
few fixed pivots (the first centroids). By Ptolemy's inequality, for any two
pivots p and s,

    d(x, c) * d(p, s)  >=  | d(x, p) * d(c, s) - d(x, s) * d(c, p) |

so in each round the cached distances of a vector, the centroids' distances to
the pivots and the pivots' among each other bound every distance from below
without touching the vector. The centroid with the least bound is measured
first; another one is measured only if its bound can still reach the best
distance. Bounds are rounded down by more than the floating-point error of
their terms, survivors are measured in whole numbers, so the assignment is the
exact one (ties go to the smaller number).

A round is one pass over the stored rows. A task adds its vectors up by
cluster; what is exchanged is one row a task, cluster and component, and what
reaches the driver are the centroids (clusters x components). New centroids are
the exact floor of sum / count. Nothing else depends on a task's place.

Defined cases: vectors that are null, of another length, or with a null or
non-finite component take no part; a null id is clustered like any other but is
a first centroid only if ids run out; rows that share an id are vectors of
their own (as first centroids in the order of their components); fewer vectors
than clusters give fewer centroids; an empty table gives an empty result; other
columns are ignored. Values beyond a long (components over 2**53 in size,
distances or sums over 2**63) fail with an error, they are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import stored, table

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Sizes up to here keep a squared distance of up to 256 components in a long.
SMALL = 1 << 26
MOST = (1 << 63) - 1
#: Bounds give way by so much of their terms: some 100 times their rounding error.
SLACK = 1e-13


def whole_vectors(vectors: DataFrame, dims: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part, components as longs."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    beyond = F.raise_error(F.lit("a component is beyond 2**53 after scaling")).cast("long")
    whole = F.transform(x, lambda c: F.when(F.abs(c * SCALE) <= float(1 << 53), F.floor(c * SCALE).cast("long"))
                        .otherwise(beyond))
    fits = F.coalesce((F.size(vec_col) == dims) & finite, F.lit(False))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col)).where(fits)
            .select("vec_id", whole.alias("v")))


def first_order(seed: int = SEED) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def first_centroids(whole: DataFrame, clusters: int, seed: int = SEED) -> list[list[int]]:
    """The vectors of the smallest digests, in their order; at most ``clusters`` rows reach the driver."""
    rows = whole.orderBy(first_order(seed).asc_nulls_last(), "v").limit(clusters).collect()
    return [list(r["v"]) for r in rows]


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to an integer point, as longs."""
    if max(np.abs(rows).max(initial=0), np.abs(point).max(initial=0)) <= SMALL and rows.shape[1] <= 256:
        gap = rows - point
        return np.einsum("ij,ij->i", gap, gap)
    gap = rows.astype(object) - point.astype(object)
    out = (gap * gap).sum(axis=1)
    if len(out) and max(out) > MOST:
        raise OverflowError("a squared distance is beyond 2**63")
    return out.astype(np.int64)


class PivotBounds:
    """Lower bounds on the distances to ``centroids`` from distances to ``pivots``."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        between = [np.sqrt(squared(pivots, p).astype(np.float64)) for p in pivots]
        self.pairs = [(i, j, between[i][j]) for i in range(len(pivots)) for j in range(i) if between[i][j] > 0]
        self.to_pivots = np.stack([np.sqrt(squared(pivots, c).astype(np.float64)) for c in centroids])

    def squared_below(self, cached: np.ndarray) -> np.ndarray:
        """(rows, centroids): never above the exact squared distance."""
        most = np.zeros((len(cached), len(self.to_pivots)))
        for i, j, apart in self.pairs:
            one = np.outer(cached[:, i], self.to_pivots[:, j])
            two = np.outer(cached[:, j], self.to_pivots[:, i])
            np.maximum(most, (np.abs(one - two) - SLACK * (one + two)) / apart, out=most)
        return most * most * (1 - SLACK)


def assign(rows: np.ndarray, cached: np.ndarray, centroids: np.ndarray, bounds: PivotBounds
           ) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each row, and how many distances were measured."""
    n = len(rows)
    below = bounds.squared_below(cached)
    cluster = below.argmin(axis=1)
    best = np.empty(n, np.int64)
    for c in range(len(centroids)):
        at = np.flatnonzero(cluster == c)
        best[at] = squared(rows[at], centroids[c])
    start, measured = cluster.copy(), n
    for c in range(len(centroids)):
        # a bound that equals the best distance may hide a tie
        at = np.flatnonzero((start != c) & (below[:, c] <= best.astype(np.float64) * (1 + SLACK)))
        measured += len(at)
        far = squared(rows[at], centroids[c])
        nearer = (far < best[at]) | ((far == best[at]) & (c < cluster[at]))
        cluster[at[nearer]], best[at[nearer]] = c, far[nearer]
    return cluster, best, measured


def _arrays(pdf: pd.DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.stack(pdf["v"].to_numpy()).astype(np.int64).reshape(len(pdf), dims)
    return rows, np.stack(pdf["cached"].to_numpy()).astype(np.float64)


def _with_pivots(whole: DataFrame, pivots: np.ndarray) -> DataFrame:
    def cache(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                rows = np.stack(pdf["v"].to_numpy()).astype(np.int64)
                far = np.stack([np.sqrt(squared(rows, p).astype(np.float64)) for p in pivots], axis=1)
                yield pdf.assign(cached=list(far))

    return whole.mapInPandas(cache, "vec_id long, v array<long>, cached array<double>")


def _sums(held: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Vectors and component sums of each cluster under ``centroids``."""
    dims = centroids.shape[1]

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = PivotBounds(pivots, centroids)
        count = [0] * len(centroids)
        total = [np.zeros(dims, object) for _ in centroids]
        for pdf in batches:
            if not len(pdf):
                continue
            rows, cached = _arrays(pdf, dims)
            cluster, _, _ = assign(rows, cached, centroids, bounds)
            small = np.abs(rows).max(initial=0) < 1 << 40            # a batch has far fewer than 2**23 rows
            for c in np.unique(cluster).tolist():
                part = rows[cluster == c]
                count[c] += len(part)
                total[c] = total[c] + (part if small else part.astype(object)).sum(axis=0).astype(object)
        seen = [c for c in range(len(centroids)) if count[c]]
        yield pd.DataFrame({"cluster": np.repeat(seen, dims).astype("int64"),
                            "dim": np.tile(np.arange(dims), len(seen)).astype("int64"),
                            "n": np.repeat([count[c] for c in seen], dims).astype("int64"),
                            "total": [str(x) for c in seen for x in total[c]]})

    sums = (held.mapInPandas(add, "cluster long, dim long, n long, total string")
            .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.collect():                                          # clusters x components rows
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["dim"]] = int(r["total"])
    return out


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
                    seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding"
                    ) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    spark = vectors.sparkSession
    whole = stored(whole_vectors(vectors, dims, id_col, vec_col), "cluster_vectors")
    first = first_centroids(whole, clusters, seed)
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    pivots = centroids = np.array(first, np.int64).reshape(len(first), dims)
    held = stored(_with_pivots(whole, pivots), "pivot_distances")
    for _ in range(rounds):
        sums = _sums(held, pivots, centroids)
        centroids = np.array([[x // sums[c][0] for x in sums[c][1]] if c in sums else centroids[c].tolist()
                              for c in range(len(centroids))], np.int64).reshape(len(first), dims)

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = PivotBounds(pivots, centroids)
        for pdf in batches:
            if len(pdf):
                rows, cached = _arrays(pdf, dims)
                cluster, best, _ = assign(rows, cached, centroids, bounds)
                yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "cluster": cluster.astype("int32"),
                                    "distance": best})

    return held.mapInPandas(last, "vec_id long, cluster int, distance long"), centroids.tolist()


def op13(spark, sf_dir: str) -> DataFrame:
    """Ten rounds with eight centroids over all vectors of 64 components."""
    done, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    done = stored(done, "clusters")
    sums = {r["cluster"]: r["far"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("far")).collect()}
    if sum(sums.values()) > MOST:
        raise OverflowError("the inertia is beyond 2**63")
    per_cluster = spark.createDataFrame(                              # a row a cluster
        [(c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
         for c, v in enumerate(centroids) if c in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (done.join(F.broadcast(per_cluster), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _sql(rounds: int, clusters: int, dims: int) -> str:
    """The rounds written out, all distances measured."""
    near = ("SELECT v.rid, arg_min(c.k, {{'d': {d}, 'k': c.k}}) AS k, min({d}) AS distance FROM vecs v"
            " CROSS JOIN c{r} c GROUP BY v.rid")
    gap = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (
    SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM vecs ORDER BY h NULLS LAST, v LIMIT {clusters}))"""]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(d=gap, r=r)})")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list(m ORDER BY i) AS v FROM (
      SELECT a.k, i, CAST(sum(v.v[i]) // count(*) - CASE WHEN sum(v.v[i]) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT) AS m
      FROM a{r} a JOIN vecs v ON v.rid = a.rid CROSS JOIN generate_series(1, {dims}) g(i) GROUP BY a.k, i) GROUP BY k
  ) n ON n.k = c.k)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vecs v ON v.rid = a.rid JOIN c{rounds} c ON c.k = a.k"""


OP13_SQL = _sql(ROUNDS, CLUSTERS, DIMS)
