"""Centroid clustering with a table of pivot distances (operator 13).

Vectors become integers, ``floor(scale * x)`` of every component. A few kept
vectors are fixed as pivots, and the distances of every vector to them are
computed once and written beside the vector. In each round the distances of the
centroids to the pivots are known too; by the triangle inequality
``|d(v, p) - d(c, p)|`` is at most ``d(v, c)`` for every pivot p, so the largest
of these differences bounds the distance of v and c from below. The centroid
with the least bound is measured exactly, in integers; of the others only those
whose bound doesn't exceed the best exact distance so far are measured. Bounds
are floating numbers with a margin far above their error, and an equal
distance is never passed over, so the result is that of comparing all.

Each round is one pass over the written table. A task gives out sums for each
cluster, not vectors, and Spark adds them up as decimals, so a hot cluster or a
very common vector sends no more rows than any other. What the driver holds
is k centroids and their pivots: k * dimensions integers, fixed by parameters.

Defined cases: vectors that are NULL, of another length, or with a NULL or
non-finite component are left out; with fewer than k vectors each starts a
centroid; equal distances go to the smaller number; empty centroids stay where
they are; equal ``vec_id`` tie by their components, and a NULL one counts as
the empty string; repeated rows each count; an empty table gives an empty
result. A component beyond +-2^27, whose squares a long can't add up, raises.
Other columns are not read; the result has the columns named below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.llm.common import materialize

K = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
PIVOTS = 24
SEED = 2
PIVOT_SEED = "pivot"
LARGEST = 2**27


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id (as text), v (array of longs) of the vectors that are whole and finite."""
    e = F.col("embedding").cast("array<double>")
    whole = (F.size(e) == dimensions) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floor = F.transform(e, lambda x: F.when(F.abs(x * scale) <= LARGEST, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond 2^27"))).cast("long"))
    # as text: pandas would make NULL and large numbers floating ones
    return vectors.where(F.coalesce(whole, F.lit(False))).select(
        F.col("vec_id").cast("string").alias("vec_id"), floor.alias("v"))


def first_vectors(vectors: DataFrame, n: int, seed: int | str) -> np.ndarray:
    """The ``n`` vectors with the least sha256 of ``seed:vec_id``, in order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("vec_id", F.lit(""))), 256)
    rows = vectors.select("v", digest.alias("h")).orderBy("h", "v").limit(n).collect()
    return np.array([r["v"] for r in rows], np.int64)


def square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` and ``b``, pair by pair."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([square(v, p[None, :]) for p in pivots], axis=1).astype(np.float64))


def nearest(v: np.ndarray, table: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """cluster and squared distance of every row, and how many exact distances
    it took."""
    n, k = len(v), len(centroids)
    bound = np.zeros((n, k))
    for j in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, j, None] - of_centroids[None, :, j]), out=bound)
    margin = 1e-9 * (1 + table.max(axis=1)[:, None] + of_centroids.max(axis=1)[None, :])
    bound = np.square(np.maximum(bound - margin, 0))
    cluster = bound.argmin(axis=1)
    best = square(v, centroids[cluster])
    exact = n
    bound[np.arange(n), cluster] = np.inf
    for c in range(k):
        rows = np.flatnonzero(bound[:, c] <= best)
        if len(rows):
            exact += len(rows)
            d = square(v[rows], centroids[c][None, :])
            nearer = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            best[rows[nearer]], cluster[rows[nearer]] = d[nearer], c
    return cluster, best, exact


def _matrix(column: pd.Series, width: int, kind: type) -> np.ndarray:
    return np.concatenate(column.to_list()).astype(kind, copy=False).reshape(-1, width)


PIECE = 4096              # rows of a batch that are worked on together


def _pieces(batches: Iterator[pd.DataFrame], width: int, pivots: int) -> Iterator[tuple]:
    for pdf in batches:
        for a in range(0, len(pdf), PIECE):
            part = pdf.iloc[a:a + PIECE]
            yield part, _matrix(part["v"], width, np.int64), _matrix(part["to_pivots"], pivots, np.float64)


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, v, to_pivots: the table of pivot distances."""
    width = pivots.shape[1]

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(to_pivots=list(pivot_distances(_matrix(pdf["v"], width, np.int64), pivots)))

    return vectors.mapInPandas(add, "vec_id string, v array<long>, to_pivots array<double>")


def cluster_sums(table: DataFrame, centroids: np.ndarray, of_centroids: np.ndarray) -> DataFrame:
    """cluster, i, total: rows and component sums of each cluster; i = -1 has
    the number of rows."""
    width, pivots = centroids.shape[1], of_centroids.shape[1]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(centroids), width + 1), object)      # exact: Python integers
        for _, v, t in _pieces(batches, width, pivots):
            cluster, _, _ = nearest(v, t, centroids, of_centroids)
            part = np.zeros((len(centroids), width + 1), np.int64)
            np.add.at(part, cluster, np.concatenate([np.ones((len(v), 1), np.int64), v], axis=1))
            total = total + part
        used = np.flatnonzero(total[:, 0] > 0)
        yield pd.DataFrame({"cluster": np.repeat(used, width + 1).astype(np.int64),
                            "i": np.tile(np.arange(-1, width, dtype=np.int64), len(used)),
                            "total": [str(x) for x in total[used].ravel()]})

    partial = table.select("v", "to_pivots").mapInPandas(sums, "cluster long, i long, total string")
    return partial.groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The centroids after one round: floor of the mean, component by
    component; ``sums`` has k * (dimensions + 1) rows at most."""
    total: dict[tuple[int, int], int] = {(r["cluster"], r["i"]): int(r["total"]) for r in sums.collect()}
    out = centroids.copy()
    for c in range(len(centroids)):
        if count := total.get((c, -1), 0):
            out[c] = [total[c, i] // count for i in range(centroids.shape[1])]
    return out


def assign(table: DataFrame, centroids: np.ndarray, of_centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance."""
    width, pivots = centroids.shape[1], of_centroids.shape[1]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v, t in _pieces(batches, width, pivots):
            cluster, distance, _ = nearest(v, t, centroids, of_centroids)
            yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "cluster": cluster.astype(np.int32),
                                "distance": distance})

    return table.mapInPandas(place, "vec_id string, cluster int, distance long")


def _summary(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return spark.createDataFrame(list(enumerate(digest)), "cluster int, centroid_sha256 string")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int | str = SEED, pivots: int = PIVOTS,
            dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id long, cluster int, distance long, cluster_inertia long, inertia
    long, centroid_sha256 string: one row for each kept row of ``vectors``
    (vec_id, embedding)."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, dimensions, scale)
    centroids = first_vectors(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    fixed = first_vectors(kept, pivots, PIVOT_SEED)
    table = materialize(with_pivots(kept, fixed), "pivot-table")
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(table, centroids, pivot_distances(centroids, fixed)))
    placed = materialize(assign(table, centroids, pivot_distances(centroids, fixed)), "clusters")
    # at most k rows, so the window over them and the broadcast are bounded
    inertia = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = placed.agg(F.sum("distance").alias("inertia"))
    per = inertia.crossJoin(F.broadcast(whole)).join(F.broadcast(_summary(spark, centroids)), "cluster")
    return placed.join(F.broadcast(per), "cluster").select(
        F.col("vec_id").cast("long").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
