"""Benchmark decontamination by winnowing.

Both sides get fingerprints: of the word k-gram hashes, the smallest of every sliding
window of k-grams. A run of words that document and item share, and that is as long as a
window of the rule, has the same k-grams on both sides, so the same smallest one: at least
one fingerprint meets. Documents whose fingerprints meet an item's are extended: every rule window around
a met fingerprint is compared whole, by the 64-bit hashes of its words.

Items of fewer words than the rule's window are one window themselves. They are grouped
by length, and each length has its own fingerprints, with k no longer than the length.

Words: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became lower case.

Defined results. Null or wordless document: 0 words, not contaminated. Null or wordless
item: never found. An item without an id hits words, but has no name to be listed by. Repeated rows: each is judged by itself. Empty benchmark: all clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .storage import saved, text_batches
from .textops import Words, buffers, grams, mix, slices

WINDOW = 13
GRAM = 5
#: A benchmark of up to this many bytes is sent along with the tasks.
SENT_BYTES = 32 << 20


def plan(length: int, gram: int = GRAM) -> tuple[int, int]:
    """Words per gram and grams per winnowing window for shared runs of ``length`` words."""
    k = min(gram, length)
    return k, length - k + 1


def winnow(h: np.ndarray, run: np.ndarray, width: int) -> np.ndarray:
    """Places of the rightmost smallest hash of every ``width`` successive grams of a text.

    ``run``: the text of each gram. Places come sorted and once.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if width == 1:
        return np.arange(len(h))
    low, place = h[:n].copy(), np.arange(n)
    for j in range(1, width):
        other = h[j : j + n]
        better = other <= low
        low[better] = other[better]
        place[better] = np.flatnonzero(better) + j
    return np.unique(place[run[:n] == run[width - 1 :]])


def fingerprints(words: Words, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each selected gram."""
    k, width = plan(length, gram)
    h, at = grams(words, k)
    keep = winnow(h, words.text[at], width)
    return h[keep], at[keep]


def windows_at(words: Words, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each start."""
    h = np.zeros(len(starts), np.uint64)
    for j in range(length):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += words.hash[starts + j]
    return mix(h)


class Benchmark:
    """Items by window length: their fingerprints, and all their windows."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int = WINDOW, gram: int = GRAM):
        self.ids, self.gram, self.lengths = list(ids), gram, []
        data, offsets = buffers(texts)
        words = Words(data, offsets)
        sizes = np.diff(words.first)
        for length in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            own = (np.minimum(sizes, window) == length)[words.text]
            prints, at = fingerprints(words, length, gram)
            starts = np.flatnonzero(own[: len(own) - length + 1])
            starts = starts[words.text[starts] == words.text[starts + length - 1]]
            h = windows_at(words, starts, length)
            order = np.argsort(h, kind="stable")
            self.lengths.append((length, np.unique(prints[own[at]]), h[order], words.text[starts][order]))

    def judge(self, texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
        """Per text: its words, its hit words, the items with occurring windows."""
        data, offsets = buffers(texts)
        for a, b in slices(offsets):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            hit, items = np.zeros(len(words.hash) + 1, np.int64), {}
            for entry in self.lengths:
                self._extend(words, *entry, hit, items)
            sums = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
            n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
            for i in range(b - a):
                found = sorted({self.ids[x] for x in items.get(i, ())} - {None})
                yield int(words.first[i + 1] - words.first[i]), int(n_hit[i]), found

    def _extend(self, words, length, prints, h, owner, hit, items) -> None:
        """Look at every window that holds a met fingerprint; each word is looked at once,
        however often fingerprints repeat."""
        own, place = fingerprints(words, length, self.gram)
        if not len(own) or not len(prints):
            return
        near = np.minimum(np.searchsorted(prints, own), len(prints) - 1)
        place = place[prints[near] == own]
        if not len(place):
            return
        k, width = plan(length, self.gram)
        around = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(around, np.maximum(place - width + 1, 0), 1)
        np.add.at(around, place + 1, -1)
        starts = np.flatnonzero(np.cumsum(around[:-1]) > 0)
        starts = starts[starts + length <= len(words.hash)]
        starts = starts[words.text[starts] == words.text[starts + length - 1]]
        found = windows_at(words, starts, length)
        low, high = np.searchsorted(h, found, "left"), np.searchsorted(h, found, "right")
        occurs = high > low
        starts, low, high = starts[occurs], low[occurs], high[occurs]
        hit[starts] += 1
        hit[starts + length] -= 1
        seen = np.unique(np.stack([words.text[starts], low, high], 1), axis=0)
        for text, first, last in seen.tolist():
            items.setdefault(text, set()).update(owner[first:last].tolist())


_RESULT = [pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()), pa.field("items", pa.list_(pa.string()))]


def _with_results(batch: pa.RecordBatch, judged: list) -> pa.RecordBatch:
    columns = [*batch.columns, *(pa.array([j[i] for j in judged], f.type) for i, f in enumerate(_RESULT))]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(f.name for f in _RESULT)])


def _judge_all(ids: list[str], texts: pa.Array, text: str, window: int, gram: int):
    def run(batches):
        benchmark = Benchmark(ids, texts, window, gram)
        for batch in batches:
            yield _with_results(batch, list(benchmark.judge(batch.column(text))))

    return run


def _judge_met(text: str, window: int, gram: int):
    """Each row brings the items that its fingerprints met, in ``_items``."""

    def run(batches):
        for batch in batches:
            met = batch.column("_items").to_pylist()
            judged = []
            for i, own in enumerate(met):
                benchmark = Benchmark([x["id"] for x in own or ()], pa.array([x["text"] for x in own or ()], pa.string()), window, gram)
                judged += benchmark.judge(batch.column(text).slice(i, 1))
            yield _with_results(batch.drop_columns(["_items"]), judged)

    return run


def _prints(lengths: list[int] | None, window: int, gram: int):
    """Fingerprints ``k, size, h`` of each text. ``lengths`` None: of the text's own window."""

    def run(batches):
        for batch in batches:
            keys, texts = batch.column("k"), batch.column("text")
            data, offsets = buffers(texts)
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sizes = np.minimum(np.diff(words.first), window)
                for length in lengths or np.unique(sizes[sizes > 0]).tolist():
                    h, at = fingerprints(words, length, gram)
                    owner = words.text[at]
                    if lengths is None:
                        mine = sizes[owner] == length
                        h, owner = h[mine], owner[mine]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(owner + a)), pa.array(np.full(len(h), length), pa.int32()), pa.array(h.view(np.int64))],
                        names=["k", "size", "h"])

    return run


def marked(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
           item_text: str = "text", window: int = WINDOW, gram: int = GRAM,
           sent_bytes: int = SENT_BYTES) -> DataFrame:
    """All columns of ``documents`` with n_words, n_hit, items (sorted ids as strings) and
    contaminated: n_hit > 0 and 20 * n_hit >= n_words. Columns of these names are replaced.

    The benchmark is measured first. Up to ``sent_bytes`` of text it goes along with the
    tasks, fingerprints meet there, and documents are not shuffled. Beyond that,
    fingerprints are joined by a shuffle, and each document is given the items that it met.
    Both ways give the same rows; ``sent_bytes=0`` takes the second.
    """
    documents = documents.drop("n_words", "n_hit", "items", "contaminated")
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item).cast("string").alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    added = StructType.fromDDL("n_words long, n_hit long, items array<string>")
    out = StructType([*documents.schema.fields, *added.fields])
    if size <= sent_bytes:
        held = items.orderBy("id", "text").toArrow()
        ids, texts = held.column("id").to_pylist(), held.column("text").combine_chunks()
        judged = text_batches(documents).mapInArrow(_judge_all(ids, texts, text, window, gram), out)
    else:
        judged = _joined(documents, items, text, window, gram, out)
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def _joined(documents, items, text, window, gram, out) -> DataFrame:
    # equal texts share a key, so that copies are met once and a frequent text is one key
    key = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    items = saved(items.withColumn("k", F.sha2(F.concat_ws("\n", "id", "text"), 256)), "items")
    prints = saved(items.select("k", "text").mapInArrow(_prints(None, window, gram), "k string, size int, h long").distinct(), "prints")
    lengths = [r[0] for r in prints.select("size").distinct().collect()]  # up to ``window`` of them
    texts = documents.select(key.alias("k"), F.col(f"`{text}`").alias("text"))
    own = text_batches(texts).mapInArrow(_prints(lengths or [window], window, gram), "k string, size int, h long").distinct()
    met = own.join(prints.withColumnRenamed("k", "item"), ["size", "h"]).select("k", "item").distinct()
    given = (
        met.join(items.withColumnRenamed("k", "item"), "item")
        .groupBy(F.col("k").alias("_key")).agg(F.collect_list(F.struct("id", "text")).alias("_items"))
    )
    joined = documents.withColumn("_k", key).join(given, F.col("_k") == F.col("_key"), "left").drop("_k", "_key")
    return text_batches(joined).mapInArrow(_judge_met(text, window, gram), out)
