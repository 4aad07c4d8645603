"""Vectors of an array column as numpy matrices, and sums of small matrices over tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether an array column is a vector: not null, no entry null, NaN or infinite."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    entries = F.col(f"`{vector}`").cast("array<double>")
    return F.coalesce(F.col(f"`{vector}`").isNotNull() & F.forall(entries, good), F.lit(False))


def matrix(lists: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are finite vectors of ``size`` entries, and these as a float64 matrix."""
    at = lists.offsets.to_numpy()
    whole = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (np.diff(at) == size))
    flat = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    found = flat[at[whole][:, None] + np.arange(size)] if len(whole) else np.zeros((0, size))
    keep = np.isfinite(found).all(1)
    return whole[keep], found[keep]


def floored(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` as int64. Beyond ``limit`` results could not be exact: an error."""
    out = np.floor(values * float(scale))
    if out.size and not np.abs(out).max() <= limit:
        raise ValueError(f"a vector has an entry beyond {limit / scale:g}: no exact 64-bit result")
    return out.astype(np.int64)


def lots(batches: Iterable[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``, whatever the session's batch size is."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


#: What a task gives out of a small array of whole numbers: place in the array, and value.
EXACT = "place int, total decimal(38,0)"


def exact_rows(array: np.ndarray) -> pa.RecordBatch:
    """The entries of an integer array that are not zero, as rows of ``EXACT``."""
    flat = array.ravel()
    place = np.flatnonzero(flat)
    total = pa.array([int(v) for v in flat[place]], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), total], names=["place", "total"])


def summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The arrays of all tasks added up by Spark, exactly. The driver gets one array."""
    out = np.zeros(int(np.prod(shape)), object)
    for row in parts.groupBy("place").agg(F.sum("total").alias("total")).collect():  # one per entry
        out[row["place"]] = int(row["total"])
    return out.reshape(shape)
