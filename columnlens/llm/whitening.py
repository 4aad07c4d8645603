"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Every entry becomes the integer ``floor(scale * c)``. An offset added to all, as 1,000,000, would
change nothing here: deviations, covariance and centred values don't have it. The fit list holds
each distinct integer vector once. Its scatter ``n * sum(x x') - S S'`` is a matrix of whole
numbers, added up exactly by Spark; it is n * n times the covariance. The matrix, whose size
is that of a vector squared and not that of the data, gets its characteristic polynomial exactly
(``charpoly``): one task per lot of primes reduces it, the driver puts the residues together and
isolates the largest roots, and one task per root finds the null space. The components project
every row.

Defined results. Rows whose vector is null or holds a null or non-finite entry have no row, nor
have empty vectors. Vectors of several sizes cannot be compared: the size that most rows have
counts (equal numbers: the larger), rows of other sizes are left out. Repeated rows are rows of
their own, but one entry of the fit list. Null ids are kept. Components with eigenvalue 0,
which exact arithmetic tells from small ones, are not given; one distinct vector has none, so
no rows. Equal eigenvalues: any orthonormal basis, the same for all rows. ``deviation`` beyond
64 bits is exact in ``deviations`` (decimal), and null in 64 bits. Entries too large for exact
sums are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import charpoly
from .storage import saved
from .vectors import EXACT, exact_rows, finite, floored, lots, matrix, summed

SCALE = 64
COMPONENTS = 16
#: integer entries, in absolute value, at most
LIMIT = 1 << 46
#: primes that one task reduces
PRIMES_PER_TASK = 16


def products(x: np.ndarray) -> np.ndarray:
    """Exact ``x' x`` and, in a last row, the column sums, as whole numbers of any size."""
    size = x.shape[1]
    out = np.zeros((size + 1, size), object)
    top = int(np.abs(x).max()) if x.size else 0
    if len(x) * top * top < 1 << 53:  # every sum is exact in double
        out[:size] = (x.T.astype(float) @ x.astype(float)).astype(np.int64).astype(object)
    elif len(x) * top * top < 1 << 63:
        out[:size] = (x.T @ x).astype(object)
    else:
        wide = x.astype(object)
        out[:size] = wide.T @ wide
    out[size] = x.sum(0).astype(object)
    return out


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums, and ``n * sum(x x') - S S'``, exactly.

    ``fit`` has a column ``x`` of integer vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        total, n = np.zeros((size + 1, size), object), 0
        for batch in lots(batches):
            own = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            total += products(own)
            n += len(own)
        yield exact_rows(np.append(total.ravel(), n))

    found = summed(fit.select("x").mapInArrow(run, EXACT), ((size + 1) * size + 1,))
    n, moments = found[-1], found[:-1].reshape(size + 1, size)
    sums = moments[size]
    return int(n), [int(s) for s in sums], [[int(v) for v in row] for row in n * moments[:size] - np.outer(sums, sums)]


def polynomial(spark: SparkSession, square: list[list[int]]) -> list[int]:
    """Characteristic polynomial, constant first. Lots of primes are tasks."""
    primes = charpoly.primes_over(2 * charpoly.coefficient_bound(square))
    cut = [primes[i : i + PRIMES_PER_TASK] for i in range(0, len(primes), PRIMES_PER_TASK)]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                rows = charpoly.hessenberg_polynomials(square, cut[k]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cut[k], pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["prime", "residues"])

    made = spark.range(0, len(cut), 1, len(cut)).mapInArrow(run, "prime long, residues array<long>")
    return charpoly.remaindered([(r["prime"], r["residues"]) for r in made.collect()])


def eigenpairs(spark: SparkSession, square: list[list[int]], count: int) -> tuple[list[Fraction], np.ndarray]:
    """The ``count`` largest eigenvalues above 0, falling, and a unit vector for each (rows).
    Each different root is a task."""
    roots = charpoly.largest_roots(polynomial(spark, square), count)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                own = charpoly.null_vectors(square, *roots[k]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(own), pa.int64()), pa.array(range(len(own)), pa.int32()),
                     pa.array(own, pa.list_(pa.float64()))], names=["root", "part", "vector"])

    if not roots:
        return [], np.zeros((0, len(square)))
    made = spark.range(0, len(roots), 1, len(roots)).mapInArrow(run, "root long, part int, vector array<double>")
    rows = sorted(made.collect(), key=lambda r: (r["root"], r["part"]))[:count]
    return [roots[r["root"]][0] for r in rows], np.array([r["vector"] for r in rows])


def _root(value: Fraction) -> float:
    """Square root of a fraction, rounded once from 30 digits."""
    return math.isqrt(int(value * 10**60)) / 10**30


def _whitened(whole: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> np.ndarray:
    """``(x - S/n)`` projected; centred first, exactly up to one division."""
    big = np.abs(whole).max() if whole.size else 0
    if n * (int(big) + 1) + max(map(abs, sums), default=0) < 1 << 62:
        centred = (n * whole - np.array(sums, np.int64)) / n
    else:
        centred = ((n * whole.astype(object) - np.array(sums, object)) / n).astype(float)
    return centred @ axes.T


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over the dimensions of ``(n * x - S)^2``, exact."""
    big = int(np.abs(whole).max()) if whole.size else 0
    most = n * big + max(map(abs, sums), default=0)
    if whole.shape[1] * most * most < 1 << 63:
        return pa.array(((n * whole - np.array(sums, np.int64)) ** 2).sum(1)).cast(pa.decimal128(38, 0))
    exact = ((n * whole.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def integers(vectors: DataFrame, vector: str, size: int, scale: int = SCALE) -> DataFrame:
    """Distinct integer vectors as ``x``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in lots(batches):
            whole = floored(matrix(batch.column("vector"), size)[1], scale, LIMIT)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(
                np.arange(0, whole.size + 1, size, dtype=np.int32), pa.array(whole.ravel()))], names=["x"])

    made = vectors.select(F.col(f"`{vector}`").alias("vector")).mapInArrow(run, "x array<long>")
    return made.distinct()  # combined before the shuffle: a common vector is a row per task


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
             scale: int = SCALE) -> DataFrame:
    """``vec_id, n, deviations, whitened, explained, identity_error`` per remaining row:
    ``whitened`` and ``explained`` are arrays with an entry per component, by falling eigenvalue.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(finite("vector"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    form = f"vec_id {kind}, n long, deviations decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], form)
    size = common["size"]
    # saved, as three passes read it
    fit = saved(integers(rows, "vector", size, scale), "fit")
    n, sums, square = scatter(fit, size)
    values, axes = eigenpairs(spark, square, components)
    if not values:
        return spark.createDataFrame([], form)
    trace = sum(square[i][i] for i in range(size))
    explained = [float(v / trace) for v in values]
    axes = axes / np.array([_root(v / n**2) for v in values])[:, None]
    error = identity_error(fit, n, sums, axes)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in lots(batches):
            at, found = matrix(batch.column("vector"), size)
            whole = floored(found, scale, LIMIT)
            k = len(explained)
            cut = np.arange(0, len(at) * k + 1, k, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(at)), pa.array(np.full(len(at), n, np.int64)),
                _deviations(whole, n, sums),
                pa.ListArray.from_arrays(cut, pa.array(_whitened(whole, n, sums, axes).ravel())),
                pa.ListArray.from_arrays(cut, pa.array(np.tile(explained, len(at)), pa.float64())),
                pa.array(np.full(len(at), error))],
                names=["vec_id", "n", "deviations", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, form)


def identity_error(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity.

    Two passes: the means of the whitened values, then the products of what is centred by them.
    """
    k, size = axes.shape

    def added(center: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]):
            total = np.zeros(k if center is None else k * k)
            for batch in lots(batches):
                w = _whitened(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size), n, sums, axes)
                total += w.sum(0) if center is None else ((w - center).T @ (w - center)).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "total"])

        made = fit.select("x").mapInArrow(run, "place int, total double")
        found = made.groupBy("place").agg(F.sum("total").alias("total")).collect()  # k or k * k rows
        return np.array([r["total"] for r in sorted(found, key=lambda r: r["place"])])

    covariance = added(added(None) / n).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def components(found: DataFrame) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``."""
    each = found.select(
        "vec_id", "n", F.expr("try_cast(deviations as bigint)").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
