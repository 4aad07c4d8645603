"""Document fingerprints by MinHash.

A text is the set of its runs of five words (fewer words: one run). Universal hash
permutations of these shingles, all of a lot of texts at once in numpy, give a signature:
per permutation the smallest value. The share of equal places in two signatures estimates
the Jaccard similarity of the sets. Signatures are cut into bands. Documents that share a band
are tied to its smallest; this only makes them candidates. All pairs in a component of ties
are compared exactly in blocks, as in ``forest``, so no document stands between two others.

Defined results. Null text: as an empty one. A text without words has the signature of the
empty set; two of them have likeness 1, and they are never near copies. Repeated rows have
equal fingerprints. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import forest
from .storage import parts, range_bounds, range_of, saved, sent_if_small, text_batches
from .textops import Permutations

PERMUTATIONS = 128
WIDTH = 5
THRESHOLD = 0.8
#: 32 bands of 4: a pair of likeness 0.8 shares none with a chance of 4 in 10^8
BANDS = 32


def _hex(signatures: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signatures.astype(">u4")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places of signatures, row by row."""
    return (a == b).mean(1)


def with_fingerprints(documents: DataFrame, text: str = "text", permutations: int = PERMUTATIONS) -> DataFrame:
    """All columns and ``fingerprint`` (hexadecimal, 8 digits per permutation)."""
    documents = documents.drop("fingerprint")
    out = StructType([*documents.schema.fields, *StructType.fromDDL("fingerprint string").fields])

    def run(lots):
        hashing = Permutations(permutations)
        for batch in lots:
            own = pa.array(_hex(hashing.signatures(batch.column(text), WIDTH)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "fingerprint"])

    return text_batches(documents).mapInArrow(run, out)


def _verified(documents: DataFrame, doc_id: str, text: str, threshold: float, bands: int):
    exact = Fraction(threshold).limit_denominator(1_000_000)
    size = PERMUTATIONS // bands
    return forest.verified(documents, doc_id, text, size, bands, size, seed=1,  # the seed of fingerprints
                           threshold=(exact.numerator, exact.denominator))


def near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """``doc_id, near, jaccard``: links that connect each group of near copies, with the exact
    similarity of the sets, ``threshold`` or more; ``near`` is the smaller id.

    A document whose set a smaller one has too is linked to the smallest of that set, and
    only that one to others. There are no more than a few links per document and block,
    however large a group is; ``near_groups`` has the number of all.
    """
    members, classes, checked = _verified(documents, doc_id, text, threshold, bands)
    equal = members.join(classes.select("digest", "class"), "digest").where(F.col("doc_id") > F.col("class"))
    return equal.select("doc_id", F.col("class").alias("near"), F.lit(1.0).alias("jaccard")).unionByName(
        checked.where("b is not null").select(
            F.greatest("a", "b").alias("doc_id"), F.least("a", "b").alias("near"), "jaccard"))


def near_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """``doc_id, class_id, group_id, n_links``: smallest document of an equal set, smallest of
    the connected links, and number of all links; one row per id."""
    return forest.grouped(*_verified(documents, doc_id, text, threshold, bands)).drop("n_rows")


def with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``near_groups``. Only documents with links are met; any
    other stands for itself. Rows without an id get null and no links."""
    rows = rows.drop("class_id", "group_id", "n_links")
    linked = saved(groups.where("n_links > 0").withColumnRenamed("doc_id", "_of"), "linked")
    met = rows.join(sent_if_small(linked), F.col("doc_id") == F.col("_of"), "left")
    return met.select(
        *rows.columns, F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def edited(own: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of the following one."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def in_order(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text, carry`` in tasks of descending id ranges, each sorted. The last row of
    a task is a copy (``carry`` 1) of the first row of the next, and of the first of all
    after the last; so each row's successor is in its own task.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = parts(documents.sparkSession)
    bounds = range_bounds(rows, "doc_id", n)
    dealt = rows.withColumn("place", range_of("doc_id", bounds))
    heads = dealt.groupBy("place").agg(F.max("doc_id").alias("head")).collect()  # one per task
    heads = sorted(((r["place"], r["head"]) for r in heads), reverse=True)
    targets = [(heads[i][0], heads[(i + 1) % len(heads)][1]) for i in range(len(heads))]
    carried = rows.withColumn("place", F.lit(0)).withColumn("carry", F.lit(0)).limit(0)
    if targets:
        targets = documents.sparkSession.createDataFrame(targets, "place int, head long")
        carried = rows.join(F.broadcast(targets), rows.doc_id.eqNullSafe(targets["head"])).select(
            "doc_id", "text", "place", F.lit(1).alias("carry"))
    both = dealt.withColumn("carry", F.lit(0)).unionByName(carried)
    return (
        both.repartitionById(n, F.col("place")).drop("place")
        .sortWithinPartitions("carry", F.desc_nulls_last("doc_id"), "text")
    )


def edited_likeness(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last floor(n/2) code points replaced by the first as many (or
    all) of the next document in descending id order; after the last comes the first. Equal
    ids: by text. Null ids come last.
    """

    def run(lots: Iterator[pa.RecordBatch]):
        hashing = Permutations(permutations)
        first = held = None  # (id, text, signature) of the first and of the last row so far
        for batch in lots:
            for at in range(0, batch.num_rows, 256):
                own = batch.slice(at, 256)
                stops = np.flatnonzero(own.column("carry").to_numpy(zero_copy_only=False))
                if len(stops):
                    own = own.slice(0, int(stops[0]) + 1)
                ids, texts = own.column("doc_id").to_pylist(), own.column("text").fill_null("").to_pylist()
                rows = ([held] if held else []) + list(zip(ids, texts, hashing.signatures(own.column("text"), WIDTH)))
                first = first or rows[0]
                if len(rows) > 1:
                    yield _compared(rows, hashing)
                held = rows[-1]
                if len(stops):
                    for _ in lots:  # further copies of equal ids
                        pass
                    return
        if held:  # ids that are all null: one task, whose first row follows its last
            yield _compared([held, first], hashing)

    return text_batches(in_order(documents, doc_id, text)).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


def _compared(rows: list[tuple], hashing: Permutations) -> pa.RecordBatch:
    """Each row but the last against its edited text and its successor."""
    new = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:])]
    signatures = np.stack([r[2] for r in rows])
    changed = hashing.signatures(pa.array(new, pa.string()), WIDTH)
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
        pa.array(_hex(signatures[:-1])), pa.array(_hex(changed)),
        pa.array(likeness(signatures[:-1], changed)), pa.array(likeness(signatures[:-1], signatures[1:]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
