"""Centroid clustering of integer vectors by scalar lookup tables.

Every entry of a vector becomes the integer ``floor(scale * x)``. Integers of one dimension
take few values, so a round tabulates, for each dimension, value that occurs and centroid, the
squared difference once. The distances of a lot of vectors to all centroids are then gathers
from these tables and sums over the dimensions, in numpy. A task builds its tables from the
values it meets and starts them over when they hold ``ENTRIES`` values, so their size has a
bound at any range of values.

A round is one pass over the vectors: tasks add up their vectors per cluster, Spark adds the
tasks up, and the driver gets ``clusters * size`` sums. All arithmetic is on whole numbers, so
results do not depend on how rows are dealt out. Every vector stays where it is.

Defined results. Vectors that are null, of another size, or hold a null or non-finite entry
have no row. Repeated rows are vectors of their own. Equal distances: the smaller cluster.
Centroids start as the vectors with the smallest hashes of their ids, equal ids by vector,
null ids last; with fewer vectors than ``clusters`` there are as many centroids as vectors.
Empty centroids stay where they are. A null id is kept. No vector: no rows. An entry so large
that a squared distance may not fit 64 bits is an error, never a wrong number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import saved
from .vectors import EXACT, exact_rows, finite, floored, lots, matrix, summed

SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: values in the tables of one task at most, over all dimensions: 84 MB with 40 centroids
ENTRIES = 1 << 18


def limit(size: int) -> int:
    """The largest entry with which every squared distance fits 63 bits."""
    return math.isqrt((1 << 61) // (4 * max(1, size)))


class Tables:
    """Per dimension the values met so far, and their squared differences to all centroids."""

    def __init__(self, centroids: np.ndarray, entries: int = ENTRIES):
        self.centroids, self.entries = centroids, entries
        self._start_over()

    def _start_over(self) -> None:
        size = self.centroids.shape[1]
        self.values = [np.zeros(0, np.int64)] * size
        self.squares = [np.zeros((0, len(self.centroids)), np.int64)] * size
        self.held = 0

    def _learn(self, d: int, fresh: np.ndarray) -> None:
        values = np.concatenate([self.values[d], fresh])
        squares = np.concatenate([self.squares[d], (fresh[:, None] - self.centroids[:, d]) ** 2])
        order = np.argsort(values)
        self.values[d], self.squares[d] = values[order], squares[order]
        self.held += len(fresh)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distance of every vector to every centroid."""
        if self.held > self.entries:
            self._start_over()
        total = np.zeros((len(vectors), len(self.centroids)), np.int64)
        for d in range(vectors.shape[1]):
            own = vectors[:, d]
            known = self.values[d]
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            fresh = own[known[at] != own] if len(known) else own
            if len(fresh):
                self._learn(d, np.unique(fresh))
                at = np.searchsorted(self.values[d], own)
            total += self.squares[d][at]
        return total


def _nearest(centroids: np.ndarray, vector: str, scale: int):
    """Per batch: rows that are vectors, their integers, nearest centroid and distance."""

    def run(batches: Iterator[pa.RecordBatch]):
        tables = Tables(centroids)
        size = centroids.shape[1]
        for batch in lots(batches):
            rows, found = matrix(batch.column(vector), size)
            whole = floored(found, scale, limit(size))
            far = tables.distances(whole)
            cluster = far.argmin(1)  # the first of equal ones
            yield batch, rows, whole, cluster, far[np.arange(len(rows)), cluster]

    return run


def start(vectors: DataFrame, vec_id: str, vector: str, size: int, clusters: int, scale: int, salt: str) -> np.ndarray:
    """The first centroids: the vectors whose salted ids have the smallest hashes."""
    kept = vectors.where((F.size(F.col(f"`{vector}`")) == size) & finite(vector))
    hashed = F.sha2(F.concat(F.lit(salt), F.col(f"`{vec_id}`").cast("string")).cast("binary"), 256)
    first = (
        kept.select(hashed.alias("hash"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
        .orderBy(F.asc_nulls_last("hash"), "vector").limit(clusters).collect()
    )
    return floored(np.array([r["vector"] for r in first], float).reshape(-1, size), scale, limit(size))


def moved(vectors: DataFrame, vector: str, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: every centroid that has vectors becomes the floor of their exact mean."""
    k, size = centroids.shape
    nearest = _nearest(centroids, vector, scale)

    def sums(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((k, size + 1), object)  # last column: number of vectors
        for _, _, whole, cluster, _ in nearest(batches):
            order = np.argsort(cluster, kind="stable")
            counts = np.bincount(cluster, minlength=k)
            present = np.flatnonzero(counts)
            if not len(present):
                continue
            begin = np.cumsum(counts)[present] - counts[present]
            total[present, :size] += np.add.reduceat(whole[order], begin, axis=0).astype(object)
            total[:, size] += counts
        yield exact_rows(total)

    found = summed(vectors.select(F.col(f"`{vector}`").alias(vector)).mapInArrow(sums, EXACT), (k, size + 1))
    return np.array([
        [int(s) // int(row[size]) for s in row[:size]] if row[size] else old.tolist()
        for row, old in zip(found, centroids)], np.int64).reshape(k, size)


def clustered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE,
              clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, salt: str = "2:") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` per vector.

    ``distance`` is squared, ``cluster_inertia`` and ``inertia`` are its sums over the cluster
    and over all vectors, ``centroid`` the integers of the final centroid.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    centroids = start(rows, "vec_id", "vector", size, clusters, scale, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, "vector", centroids, scale)
    nearest = _nearest(centroids, "vector", scale)

    def assign(batches: Iterator[pa.RecordBatch]):
        for batch, kept, _, cluster, distance in nearest(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(kept)), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    form = f"vec_id {kind}, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], form + ", cluster_inertia long, inertia long, centroid array<long>")
    # saved, as it is read for the sums and for the rows
    found = saved(rows.mapInArrow(assign, form), "clusters")
    most = (1 << 63) - 1
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row per cluster
    table = spark.createDataFrame(
        [(c, min(s, most), min(sum(sums.values()), most), centroids[c].tolist()) for c, s in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(table), "cluster").select(  # at most ``clusters`` rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
