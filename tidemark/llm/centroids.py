"""Centroid clustering by equal-average equal-variance search, in whole numbers.

A vector's squared distance to a centroid is at least ``(Sx - Sc)^2 / k`` for component sums ``Sx`` and
``Sc`` of ``k`` components, and at least that plus ``(Vx - Vc)^2`` for the lengths ``Vx`` and ``Vc`` of what
is left without the mean. The centroids are sorted by component sum; from a vector's own sum the search
goes outward to both sides. A side ends where the first bound is over the least distance so far, a
centroid whose second bound is over it is skipped, and the rest get their exact integer distance.

Centroids are at most ``k`` rows and travel with the tasks. Each task adds up its vectors by cluster, so
a round brings one row a task and cluster to the exchange, and one a cluster to the driver.

Defined results: kept are vectors with ``size`` components, none null, NaN or infinite, and none beyond
``LARGEST`` after scaling, from where a squared distance would not fit a long. Equal distances go to the
smaller number. Rows that share an id are separate vectors; a null id comes last in the draw and is kept.
Fewer vectors than centroids give fewer centroids, an empty table no rows. Columns are chosen by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Largest magnitude of a scaled component.
LARGEST = 1 << 27
#: What rounding may add to a bound that is computed in floating point: a share of it, and an amount.
_SLACK, _AMOUNT = 1e-9, 1.0


def whole(df: DataFrame, vec: str = "vec_id", value: str = "embedding", size: int = SIZE) -> DataFrame:
    """``vec_id, v``: the kept vectors, scaled and floored."""
    x = F.col(value).cast("array<double>")
    fits = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= LARGEST / SCALE)
    kept = df.where(F.col(value).isNotNull() & (F.size(value) == size)).where(F.forall(x, fits))
    return kept.select(F.col(vec).alias("vec_id"), F.transform(x, lambda e: F.floor(SCALE * e).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id, in its order."""
    draw: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = vectors.select(draw.alias("draw"), "v").orderBy(F.col("draw").asc_nulls_last(), "v").limit(k)
    rows = [r.v for r in top.collect()]
    return np.array(rows, np.int64)


class Search:
    """Nearest of a few centroids, exactly; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.order], sums[self.order]
        self.spread = _spread(self.centroids, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's centroid, and how many distances were computed."""
        n, k, size = len(x), len(self.sums), x.shape[1]
        sums = x.sum(1)
        spread = _spread(x, sums)
        best, found, tried = np.full(n, np.iinfo(np.int64).max), np.full(n, k), 0
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        rows = np.arange(n)
        while len(rows):
            # The nearer side by mean goes first; a side that has run out is infinitely far.
            l, r = left[rows], right[rows]
            gap_l = np.where(l >= 0, sums[rows] - self.sums[np.maximum(l, 0)], np.iinfo(np.int64).max)
            gap_r = np.where(r < k, self.sums[np.minimum(r, k - 1)] - sums[rows], np.iinfo(np.int64).max)
            go_left = gap_l <= gap_r
            gap, c = np.where(go_left, gap_l, gap_r), np.where(go_left, l, r)
            on = gap < np.iinfo(np.int64).max
            mean = np.where(on, gap, 0).astype(np.float64) ** 2 / size
            limit = best[rows].astype(np.float64)
            # What lies further out has a larger mean bound still.
            on &= mean * (1 - _SLACK) <= limit
            rows, c, mean, limit, go_left = rows[on], c[on], mean[on], limit[on], go_left[on]
            left[rows[go_left]] -= 1
            right[rows[~go_left]] += 1
            near = (mean + (spread[rows] - self.spread[c]) ** 2) * (1 - _SLACK) - _AMOUNT <= limit
            own, c = rows[near], c[near]
            d = ((x[own] - self.centroids[c]) ** 2).sum(1)
            tried += len(own)
            number = self.order[c]
            better = (d < best[own]) | (d == best[own]) & (number < found[own])
            best[own[better]], found[own[better]] = d[better], number[better]
        return found, best, tried


def _spread(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Length of what is left of each row without its mean."""
    return np.sqrt(((x - sums[:, None] / x.shape[1]) ** 2).sum(1))


def _rows(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    kind, size = vectors.schema["vec_id"].dataType.simpleString(), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            found, distance, _ = search.nearest(_rows(batch, size))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(found, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, total, count = Search(centroids), np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _rows(batch, size)
            found, _, _ = search.nearest(x)
            order = np.argsort(found, kind="stable")
            held, first, n = np.unique(found[order], return_index=True, return_counts=True)
            if len(held):
                total[held] += np.add.reduceat(x[order], first)
                count[held] += n
        held = np.flatnonzero(count)
        sums = pa.array(total[held].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(count[held], pa.int64()), sums], ["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n bigint, s array<bigint>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(size)]).alias("s"))
    out = centroids.copy()
    for row in total.collect():
        out[row.cluster] = [s // row.n for s in row.s]
    return out


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids of ``whole`` vectors after all rounds."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(df: DataFrame, vec: str = "vec_id", value: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    vectors = durable(whole(df, vec, value, size))
    centroids = fit(vectors, k, rounds, seed)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    found = durable(assign(vectors, centroids))
    # A row a centroid: bounded by k.
    totals = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(c, totals[c], sum(totals.values()), digest(centroids[c])) for c in sorted(totals)]
    known = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
