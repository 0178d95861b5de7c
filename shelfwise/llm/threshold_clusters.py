"""Centroid clustering: nearest centroids by the threshold algorithm over sorted lists."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import staged
from shelfwise.llm.integer_vectors import LIMIT, integers, matrix, moved, summed

FAR = np.int64(4 * LIMIT)


class SortedLists:
    """Centroids sorted by each component on its own; vectors walk outward from their values."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        self.number = np.argsort(self.centroids, axis=0, kind="stable")
        ordered = np.take_along_axis(self.centroids, self.number, axis=0)
        edge = np.full((1, ordered.shape[1]), FAR)
        self.values = np.concatenate([-edge, ordered, edge])  # a sentinel at either end

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector (ties to the smaller number) and its squared distance.

        Every step takes the next nearest value of each list, left or right of the vector's own, and
        the exact distance of each centroid met for the first time.  A centroid not yet met is at
        least as far in every component as that list's frontier, so a vector stops when the sum of
        squared frontier distances is strictly over the best exact distance, or all have been met.
        """
        count, dims = self.centroids.shape
        vectors, column = vectors.astype(np.int64), np.arange(dims)
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        chosen = np.zeros(len(vectors), np.int64)
        right = np.stack([np.searchsorted(self.values[1:-1, d], vectors[:, d]) for d in range(dims)], axis=1) + 1
        left, active, seen = right - 1, np.arange(len(vectors)), np.zeros((len(vectors), count), bool)
        while len(active):
            x = vectors[active]
            below, above = x - self.values[left, column], self.values[right, column] - x
            down = below <= above
            at = np.where(down, left, right)
            left, right = left - down, right + ~down
            fresh = np.zeros((len(active), count), bool)
            fresh[np.arange(len(active))[:, None], self.number[at - 1, column]] = True
            fresh &= ~seen
            seen |= fresh
            who, centroid = np.nonzero(fresh)
            self.take(active[who], centroid, vectors, best, chosen)
            frontier = np.where(down, below, above)
            going = ((frontier * frontier).sum(axis=1) <= best[active]) & ~seen.all(axis=1)
            active, left, right, seen = active[going], left[going], right[going], seen[going]
        return chosen, best

    def take(self, who: np.ndarray, centroid: np.ndarray, vectors: np.ndarray, best: np.ndarray, chosen: np.ndarray) -> None:
        """Exact distances of the pairs (by vector, then by centroid); a nearer one, or as near and smaller, is chosen."""
        if not len(who):
            return
        away = np.empty(len(who), np.int64)
        for s in range(0, len(who), 1 << 14):
            gap = vectors[who[s : s + (1 << 14)]] - self.centroids[centroid[s : s + (1 << 14)]]
            away[s : s + (1 << 14)] = (gap * gap).sum(axis=1)
        order = np.lexsort((centroid, away, who))
        first = order[np.insert(who[order][1:] != who[order][:-1], 0, True)]
        who, centroid, away = who[first], centroid[first], away[first]
        better = (away < best[who]) | ((away == best[who]) & (centroid < chosen[who]))
        best[who[better]], chosen[who[better]] = away[better], centroid[better]


@dataclass(frozen=True)
class Clustering:
    """``clusters`` centroids of ``dims`` components, moved ``rounds`` times; ``seed`` picks the starting rows."""

    clusters: int = 40
    dims: int = 64
    rounds: int = 5
    scale: int = 256
    seed: str = "2"
    rows: int = 1024

    def parts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, self.rows):
                yield batch.slice(s, self.rows)

    def sums(self, batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> np.ndarray:
        """Count and sums of each cluster, flat."""
        lists, total = SortedLists(centroids), np.zeros((len(centroids), 1 + self.dims), np.int64)
        for part in self.parts(batches):
            vectors = matrix(part.column("v"))
            cluster, _ = lists.nearest(vectors)
            np.add.at(total, cluster, np.column_stack([np.ones(len(vectors), np.int64), vectors]))
        return total.ravel()

    def assigned(self, batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for part in self.parts(batches):
            cluster, away = lists.nearest(matrix(part.column("v")))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cluster, pa.int32()), pa.array(away, pa.int64())], ["id", "cluster", "distance"])


def threshold_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", job: Clustering = Clustering()) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``, ``centroid_sha256`` by vector.

    Components become ``floor(scale * x)``.  The rows with the smallest sha256 of ``<seed>:<id>`` are the first
    centroids, in this order; ``rounds`` times all vectors go to the nearest centroid (squared distance, ties to the
    smaller number) and centroids to the floor of their vectors' mean; empty ones stay.  Then vectors are assigned once more.

    Vectors are stored as integers once and each round reads them; a task sends its sums, the driver gets one number a
    centroid and component.  Nothing is shuffled but these.

    Vectors of another length than ``dims``, null ones and those with null or non-finite components take no part, nor
    (see ``integer_vectors``) integers too large for distances in a long.  Repeated rows count each and tie by their
    vector; rows without an id are the last to become centroids.  With fewer rows than ``clusters`` there are fewer
    centroids, with no rows no result.  Other columns stay outside, whatever their names.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), integers(vectors[vector_col], job.scale).alias("v"))
    rows = staged(rows.filter(F.size("v") == job.dims), "integers")
    drawn = F.sha2(F.concat(F.lit(f"{job.seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), "v").limit(job.clusters).select("v").collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(len(first), job.dims)
    for _ in range(job.rounds if first else 0):
        totals = summed(rows.select("v"), lambda batches: job.sums(batches, centroids), centroids.shape[0] * (1 + job.dims)).reshape(len(first), -1)
        centroids = moved(centroids, totals[:, 1:], totals[:, 0])
    found = staged(rows.mapInArrow(lambda batches: job.assigned(batches, centroids), "id long, cluster int, distance long"), "assigned")
    sums = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    made = [(i, sums.get(i, 0), sum(sums.values()), c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    # One row a centroid.
    named = vectors.sparkSession.createDataFrame(made, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256",
    )
