"""Hashed character n-grams of many texts at once, in numpy over code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .textops import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, one space around each, and where each begins."""
    folded = [f" {t.lower()} " for t in texts]
    offsets = np.zeros(len(folded) + 1, np.int64)
    np.cumsum([len(t) for t in folded], out=offsets[1:])
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, offsets


def gram_buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each n-gram size the bucket of the n-gram at every place (short at the end)."""
    h = np.zeros(len(points), np.uint64)
    wide = points.astype(np.uint64)
    for j in range(max(sizes)):
        n = len(points) - j
        if n <= 0:
            return
        h = h[:n] * _ODD
        h += wide[j:]
        if j + 1 in sizes:
            yield j + 1, (mix(h + np.uint64(j)) >> np.uint64(64 - bits)).astype(np.int64)


def batches(texts: list, limit: int = 1 << 17) -> Iterator[tuple[int, list[str]]]:
    """Whole texts in lots of about ``limit`` characters; null is empty."""
    lot, first, size = [], 0, 0
    for i, t in enumerate(texts):
        lot.append(t or "")
        size += len(lot[-1]) + 2
        if size >= limit:
            yield first, lot
            lot, first, size = [], i + 1, 0
    if lot:
        yield first, lot
