"""Runs of characters (grams) of texts that are possibly among wanted ones.

Every place of a text is looked at, so this is done on whole batches of code points: the
number of a gram is made of those of two shorter ones that cover it, and two filters of
``SLOTS`` places say which numbers wanted grams have. They let a few others pass and drop none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOTS = 1 << 20
_PER_ROW = 1 << 15  # places in a row of ``bitmap_construct_agg``
_BYTES = 1 << 18  # about so much text is looked at in one go
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT, _FIRST, _SECOND = np.uint64(32), np.uint64(44), np.uint64(24)


def numbers(text: str, widths: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Per width, the numbers of the grams at all places of ``text``."""
    own = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    half, wanted = 1, set(widths)

    def mixed(width: int, found: np.ndarray) -> tuple[int, np.ndarray]:
        out = (found ^ np.uint64(width)) * _ONE
        out ^= out >> _SHIFT
        return width, out * _TWO

    if 1 in wanted and len(own):
        yield mixed(1, own)
    while half < max(wanted, default=0):
        left = own * _TWO
        left = (left ^ left >> _SHIFT) * _ONE
        for width in range(half + 1, 2 * half + 1):
            step = width - half
            if len(own) > step and (width in wanted or width == 2 * half):
                found = left[:-step] + own[step:]
                if width in wanted:
                    yield mixed(width, found)
        if len(own) <= half:
            return
        own, half = found, 2 * half


def _slots(found: np.ndarray, shift: np.uint64 = _FIRST) -> np.ndarray:
    return (found >> shift & np.uint64(SLOTS - 1)).astype(np.int64)


def filter_of(grams: DataFrame, gram: str, widths: Sequence[int]) -> bytes:
    """Two times ``SLOTS`` bits, set where a gram of ``grams`` has its places. Grams have one of
    ``widths``."""

    def places(lots):
        for batch in lots:
            own = [n for g in batch.column(0).to_pylist() if g for _, n in numbers(g, [len(g)])]
            found = np.concatenate(own) if own else np.zeros(0, np.uint64)
            both = np.concatenate([_slots(found), _slots(found, _SECOND) + SLOTS])
            yield pa.RecordBatch.from_arrays([pa.array(both)], names=["slot"])

    slot = F.col("slot")
    rows = (
        grams.select(gram).mapInArrow(places, "slot bigint")
        .groupBy((slot / _PER_ROW).cast("int").alias("row"))
        .agg(F.bitmap_construct_agg(slot % _PER_ROW).alias("bits"))
        .collect()  # 2 * SLOTS bits at most
    )
    size = _PER_ROW // 8
    whole = bytearray(2 * SLOTS // 8)
    for r in rows:
        whole[r["row"] * size : (r["row"] + 1) * size] = r["bits"]
    return bytes(whole)


def possible(texts: DataFrame, text: str, widths: Sequence[int], wanted: bytes, grams: str = "grams") -> DataFrame:
    """Rows with a gram that passes the filter, and ``grams``: each such gram once."""
    out = StructType([*texts.schema.fields, *StructType.fromDDL(f"`{grams}` array<string>").fields])

    def run(lots):
        passing = np.unpackbits(np.frombuffer(wanted, np.uint8), bitorder="little").view(bool)
        for batch in lots:
            step = max(1, _BYTES * batch.num_rows // max(1, batch.column(text).nbytes))
            for i in range(0, batch.num_rows, step):
                own = batch.slice(i, step)
                rows, found = _found(own.column(text).to_pylist(), widths, passing)
                kept, first = np.unique(rows, return_index=True)
                lists = pa.ListArray.from_arrays(
                    np.append(first, len(rows)).astype(np.int32), pa.array(found, pa.string()))
                columns = [c.take(pa.array(kept)) for c in own.columns]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*own.schema.names, grams])

    return texts.mapInArrow(run, out)


def _found(texts: list, widths: Sequence[int], passing: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Number of the text and gram, each pair once, in the order of texts."""
    whole = "".join(t or "" for t in texts)
    ends = np.cumsum([len(t or "") for t in texts])
    parts = []
    for width, own in numbers(whole, widths):
        at = np.flatnonzero(passing[_slots(own)])
        at = at[passing[_slots(own[at], _SECOND) + SLOTS]]
        row = np.searchsorted(ends, at, "right")
        inside = at + width <= ends[row]
        at, row = at[inside], row[inside]
        order = np.lexsort((own[at], row))
        at, row = at[order], row[order]
        again = (row[1:] == row[:-1]) & (own[at][1:] == own[at][:-1])
        new = np.append(True, ~again)[: len(at)]
        # two grams of one number: kept apart by their text
        same = [whole[a : a + width] for a in at.tolist()]
        new[1:] |= np.array([x != y for x, y in zip(same[1:], same)], bool)
        parts.append((row[new], [g for g, n in zip(same, new.tolist()) if n]))
    rows = np.concatenate([r for r, _ in parts]) if parts else np.zeros(0, np.int64)
    grams = [g for _, own in parts for g in own]
    order = np.argsort(rows, kind="stable")
    return rows[order], [grams[i] for i in order.tolist()]
