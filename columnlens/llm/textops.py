"""Words, shingles and their hashes for a batch of texts at once, in numpy over UTF-8 bytes.

A word is a run of ``0-9``, ``a-z`` and all code points from U+0080 up, after A-Z became
lower case. In UTF-8 these code points are exactly the bytes from 0x80 up, so bytes are
enough to find words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        held = np.full(size, base, np.uint64)
        held[0] = 1
        _powers[name] = held = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and where each text begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes, so that work arrays stay in cache."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """Words of some texts: their text number, first and end byte, and hash."""

    __slots__ = ("n_texts", "text", "start", "end", "hash", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.n_texts = len(offsets) - 1
        data = _LOWER[data]
        inside = _WORD[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: word number at which each text begins, and their count at the end
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(self.n_texts), np.diff(self.first))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(_ODD, len(data), "up"), out=sums[1:])
        down = _power(_INVERSE, len(data) + 1, "down")
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])


def grams(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text, and the word each begins at."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.flatnonzero(words.text[:n] == words.text[width - 1 :])
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h *= _ODD
        h += words.hash[j : j + n]
    return mix(h[whole]), whole


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes with repeats and, per text, where its own begin (and the end).

    A text of fewer than ``width`` words, but not none, has one shingle: all its words.
    """
    h, at = grams(words, width)
    owner = words.text[at]
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            some = sizes[short] > j
            whole[some] = whole[some] * _ODD + words.hash[words.first[short[some]] + j]
        whole = mix(whole ^ sizes[short].astype(np.uint64))
        h, owner = np.concatenate([h, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    return h, np.searchsorted(owner, np.arange(words.n_texts + 1))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = buffers(texts)
    for a, b in slices(offsets):
        own = offsets[a : b + 1] - offsets[a]
        h, at = shingles(Words(data[offsets[a] : offsets[b]], own), width)
        for i in range(b - a):
            yield np.unique(h[at[i] : at[i + 1]])


class Permutations:
    """Universal hash permutations ``a * x + b`` mod 2^64; their top 32 bits are compared."""

    def __init__(self, count: int, seed: int = 1):
        random = np.random.default_rng(seed)
        self.a = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
        self.count = count

    def signatures(self, texts: pa.Array, width: int) -> np.ndarray:
        """MinHash signature per text (uint32); a text without words has the largest value."""
        data, offsets = buffers(texts)
        out = np.full((len(offsets) - 1, self.count), 0xFFFFFFFF, np.uint32)
        for first, last in slices(offsets):
            own = offsets[first : last + 1] - offsets[first]
            h, at = shingles(Words(data[offsets[first] : offsets[last]], own), width)
            filled = np.flatnonzero(np.diff(at))
            if not len(filled):
                continue
            begin = at[filled]
            work = np.empty_like(h)
            for k in range(self.count):
                np.multiply(h, self.a[k], out=work)
                work += self.b[k]
                low = np.minimum.reduceat(work, begin)
                out[first + filled, k] = (low >> np.uint64(32)).astype(np.uint32)
        return out
