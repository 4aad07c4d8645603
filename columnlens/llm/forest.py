"""N-gram Jaccard join by MinHash bands, where an LSH forest would end.

A text is the set of its runs of five words (fewer words: one run). Texts with equal sets
are one class, which goes on as one row. Each class has ``TREES`` MinHash labels of up to
``DEPTH`` values. Two classes of likeness s share a prefix of length k in some tree with the
chance 1 - (1 - s^k)^TREES. No tries are built: one length is computed, the longest with
which that chance, at the threshold, reaches ``RECALL``, and equal prefixes are grouped. What
meets under a longer prefix meets under it too, so shortening in rounds finds the same.

Classes under one prefix belong to its smallest class. A class is tied to the least of those it
belongs to, and these to one another, so m classes give about m ties however many prefixes they
share. All pairs that share a prefix lie within one component of
ties. Components are verified exactly: their sets are dealt into blocks of ``BLOCK``, and
every pair of blocks is one small matrix product that counts the shared shingles of all
its pairs. A block pair gives out, per class, the number of its links, and links that
connect what is connected; never all pairs. So the work of a component of m near copies is
m * m / 2 comparisons within tasks, while what is sent is m * m / BLOCK sets and m rows of
counts per block.

Result: one row per document with its class, group (smallest document of the connected
links), number of links to other documents, equal sets included, and number of its rows.

Defined results. Null text and a text without words: no links, a group of its own.
Repeated rows are one document; of several texts under one id, that with the smallest
digest of its set counts (one without words first). Rows without an id have no document to
give a row for. Two equal rows of ``documents`` therefore give one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .storage import parts, saved, sent_if_small, text_batches
from .textops import Permutations, Words, buffers, shingles, slices

WIDTH = 5
THRESHOLD = (4, 5)  # 0.8
TREES = 24
DEPTH = 6
RECALL = 0.9999
BLOCK = 256


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with the
    chance ``recall``; the shortest is 1."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def _digest(values: np.ndarray) -> bytes:
    """128 bits that are equal for equal sets."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _labels(length: int, trees: int, depth: int, seed: int):
    """Per text: digest and size of its set, and its prefix in every tree."""

    def run(lots: Iterator[pa.RecordBatch]):
        hashing = Permutations(trees * depth, seed=seed)
        weigh = np.random.default_rng(3).integers(1, 1 << 62, (trees, length), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in lots:
            for at in range(0, batch.num_rows, 1024):
                own = batch.slice(at, 1024)
                texts = own.column("text")
                data, offsets = buffers(texts)
                digests, sizes = [], []
                for a, b in slices(offsets):
                    h, cut = shingles(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), WIDTH)
                    for i in range(b - a):
                        held = np.unique(h[cut[i] : cut[i + 1]])
                        digests.append(_digest(held) if len(held) else None)
                        sizes.append(len(held))
                signatures = hashing.signatures(texts, WIDTH).reshape(len(texts), trees, depth)[:, :, :length]
                keys = (signatures.astype(np.uint64) * weigh).sum(2, dtype=np.uint64)
                keys ^= keys >> np.uint64(29)
                flat = pa.array(keys.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([
                    own.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, trees, dtype=np.int32), flat)],
                    names=["doc_id", "digest", "size", "prefixes"])

    return run


def _blocks(rows: list[tuple], threshold: tuple[int, int]) -> tuple[list, list]:
    """Link counts per class and connecting links, with their likeness, of one pair of blocks.

    ``rows``: (side, class, members, shingles); in a block paired with itself all have side 0.
    """
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1]))
    rows = [rows[i] for i in order]
    n = len(rows)
    size = np.array([len(r[3]) for r in rows], np.int64)
    members = np.array([r[2] for r in rows], np.int64)
    flat = np.concatenate([r[3] for r in rows])
    _, column = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(n), size)
    shared = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 1 << 13
    for first in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        shared += part @ part.T  # whole numbers: exact in float32 up to 2^24
    both = shared.astype(np.int64)
    top, bottom = threshold
    linked = bottom * both >= top * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    side = np.array([r[0] for r in rows])
    if side.any():  # pairs within a block belong to the block paired with itself
        linked &= side[:, None] != side[None, :]
    counts = [(rows[i][1], int(members[linked[i]].sum())) for i in np.flatnonzero(linked.any(1)).tolist()]
    seen, ties = np.zeros(n, bool), []
    for root in range(n):
        if seen[root] or not linked[root].any():
            continue
        seen[root], front = True, [root]
        while front:
            i = front.pop()
            fresh = np.flatnonzero(linked[i] & ~seen)
            seen[fresh] = True
            ties += [(rows[i][1], rows[j][1], both[i, j] / (size[i] + size[j] - both[i, j])) for j in fresh.tolist()]
            front += fresh.tolist()
    return counts, ties


def _verify(threshold: tuple[int, int]):
    """Rows come sorted by block pair; one pair of blocks is held at a time."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        counts, ties = _blocks(rows, threshold)
        found = [(c, None, n, None) for c, n in counts] + [(a, b, None, v) for a, b, v in ties]
        columns = list(zip(*found)) if found else ([], [], [], [])
        kind = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kind)], names=["a", "b", "links", "jaccard"])

    def run(lots: Iterator[pa.RecordBatch]):
        key, rows = None, []
        for batch in lots:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("component", "low", "high"))))
            side, own, members = (batch.column(c).to_pylist() for c in ("side", "class", "members"))
            sets = batch.column("shingles")
            at, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
            for i, k in enumerate(keys):
                if k != key and rows:
                    yield out(rows)
                    rows = []
                key = k
                rows.append((side[i], own[i], members[i], flat[at[i] : at[i + 1]].copy()))
        if rows:
            yield out(rows)

    return run


def _sets(lots: Iterator[pa.RecordBatch]):
    """The shingle sets of texts, in place of the texts and their digests. Other texts that
    bear the id of a class are passed over."""
    for batch in lots:
        for at in range(0, batch.num_rows, 512):
            own = batch.slice(at, 512)
            data, offsets = buffers(own.column("text"))
            held = []
            for a, b in slices(offsets):
                h, cut = shingles(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), WIDTH)
                held += [np.unique(h[cut[i] : cut[i + 1]]) for i in range(b - a)]
            keep = [i for i, d in enumerate(own.column("digest").to_pylist()) if len(held[i]) and _digest(held[i]) == d]
            held = [held[i] for i in keep]
            flat = np.concatenate(held).view(np.int64) if held else np.zeros(0, np.int64)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int32)
            names = [c for c in own.schema.names if c not in ("text", "digest")]
            columns = [own.column(c).take(pa.array(keep, pa.int64())) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(cut, pa.array(flat))], names=[*names, "shingles"])


def joined(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", trees: int = TREES,
           depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, group_id, n_links``: see the module."""
    top, bottom = THRESHOLD
    length = prefix_length(top / bottom, trees, depth, recall)
    return grouped(*verified(documents, doc_id, text, length, trees, depth))


def verified(documents: DataFrame, doc_id: str, text: str, length: int, trees: int, depth: int, seed: int = 2,
             threshold: tuple[int, int] = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with the digests of their sets; classes of equal sets; and, of all pairs in
    the components of classes that share a prefix, link counts (``a, links``) and links that
    connect what is linked (``a, b, jaccard``)."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    made = text_batches(rows).mapInArrow(_labels(length, trees, depth, seed), "doc_id long, digest binary, size int, prefixes array<long>")
    labelled = saved(
        made.groupBy("doc_id")
        .agg(F.min(F.struct("digest", "size", "prefixes")).alias("m"), F.count("*").alias("n_rows"))
        .select("doc_id", "n_rows", "m.*"), "labels")
    members = labelled.select("doc_id", "n_rows", "digest")
    classes = saved(
        labelled.where("digest is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("class"), F.count("*").alias("members"),
             F.first("prefixes").alias("prefixes")), "classes")
    prefixes = classes.select("class", F.posexplode("prefixes").alias("tree", "prefix"))
    low = prefixes.groupBy("tree", "prefix").agg(F.min("class").alias("low"), F.count("*").alias("n")).where("n > 1")
    # a class meets up to one low per tree: it is tied to the least of them, and so are the others,
    # once for all classes; this connects the same as a tie to each
    least = F.min("low").over(Window.partitionBy("class"))
    ties = (
        prefixes.join(low, ["tree", "prefix"]).select("class", "low", least.alias("b"))
        .select(F.explode(F.array("class", "low")).alias("a"), "b").where("a <> b").distinct()
    )
    candidate = components(ties)
    # blocks of each component: a class falls into one by a hash; the ids are few and small
    count = candidate.groupBy("component").agg(F.count("*").alias("n"))
    placed = candidate.join(count, "component").select(
        F.col("node").alias("class"), "component",
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    placed = saved(placed.join(classes.select("class", "digest", "members"), "class"), "placed")
    near = sent_if_small(placed)  # most texts are nobody's near copy: they need not move
    sets = rows.join(near, rows.doc_id == near["class"]).select(
        "class", "digest", "component", "members", "block", "blocks", "text")
    sets = sets.mapInArrow(
        _sets, "class long, component long, members long, block int, blocks int, shingles array<long>")
    # each block meets itself (side 0) and every other once: the lower has side 0, the higher 1
    dealt = sets.select(
        "class", "component", "members", "shingles", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "class", "component", "members", "shingles", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    n = parts(spark)
    checked = saved(
        dealt.repartition(n, "component", "low", "high").sortWithinPartitions("component", "low", "high")
        .select("component", "low", "high", "side", "class", "members", "shingles")
        .mapInArrow(_verify(threshold), "a long, b long, links long, jaccard double"), "links")
    return members, classes, checked


def grouped(members: DataFrame, classes: DataFrame, checked: DataFrame) -> DataFrame:
    """``doc_id, class_id, group_id, n_links, n_rows`` of what ``verified`` gives."""
    groups = components(checked.where("b is not null").select("a", "b"))
    links = checked.where("links is not null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    found = (
        classes.select("class", "digest", "members").join(links, "class", "left")
        .join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
        .select("digest", "class", F.coalesce("component", "class").alias("group_id"),
                (F.coalesce("links", F.lit(0)) + F.col("members") - 1).cast("long").alias("n_links"))
    )
    return members.join(found, "digest", "left").select(
        "doc_id", F.coalesce("class", "doc_id").alias("class_id"),
        F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_rows")


def one_of_each_group(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without all but the smallest id of each group. Of several rows under one
    id the smallest stays; rows without an id stay all."""
    found = saved(joined(documents, doc_id, text), "groups")
    gone = sent_if_small(saved(found.where("doc_id <> group_id").select("doc_id"), "gone"))
    kept = documents.join(gone, documents[doc_id] == gone.doc_id, "left_anti")
    repeated = saved(found.where("n_rows > 1 and doc_id = group_id").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return kept
    mark = sent_if_small(repeated)
    single = kept.join(mark, kept[doc_id] == mark.doc_id, "left_anti")
    several = kept.join(mark, kept[doc_id] == mark.doc_id, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    return single.unionByName(several.groupBy(doc_id).agg(F.min(whole).alias("_row")).select("_row.*"))
