"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of character n-grams of all sizes in ``SIZES`` that
both have, over the geometric mean of their own counts: presence counts, not frequency.
N-grams are hashed into ``2 ** BITS`` places. Nyström: a text is described by its kernel
values with a few landmark texts, brought to unit covariance by the inverse root of the
landmarks' own kernel matrix. One ridge regression per language learns +1 for its texts
and -1 for others on these features (one versus rest); scores are one matrix product of
the presence matrix of a lot of texts with the landmarks' presence matrix, and one more
with the coefficients. Presence tells little about a long text, which has nearly every
n-gram once: texts are cut into pieces of about ``PIECE`` characters, all of which are
learned from and scored, and a text's regression values are their mean by length.

Training rows are a bounded sample: up to ``MAX_ROWS`` texts with a language, of up to
``MAX_CHARS`` characters, chosen by a hash, as many of each language as there are or fit.
Copies of a text in one language count once. Landmarks are different pieces, by a hash.
All else covers every text whole.

Defined results. Null text, or one without any letter: ``und`` with score 0. Null
languages and texts are not learned from. Nothing to learn from: ``und``, 0. One language:
that one, 1. Equal regression values: the first language in order.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .chargrams import batches, code_points, gram_buckets
from .storage import text_batches

SIZES = (1, 2, 3)
BITS = 13
PIECE = 3000
LANDMARKS = 160
MAX_ROWS = 2400
MAX_CHARS = 20_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def presence(texts: list[str]) -> np.ndarray:
    """Texts by n-gram places, 1 where the text has an n-gram; rows of unit length."""
    points, offsets = code_points(texts)
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) << BITS, np.diff(offsets))
    for n, bucket in gram_buckets(points, SIZES, BITS):
        if n == 1:
            flat[row + bucket] = 1
        else:
            inside = row[: len(bucket)] == row[n - 1 :]
            flat[(row[: len(bucket)] + bucket)[inside]] = 1
    return out / np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The texts cut into pieces of about ``PIECE`` characters, and the text of each."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        n = max(1, round(len(t) / PIECE))
        size = -(-len(t) // n)
        parts += [t[j * size : (j + 1) * size] for j in range(n)]
        owner += [i] * n
    return parts, np.array(owner, np.int64)


class Model:
    """Landmarks (places by landmarks) and regression coefficients (landmarks by languages)."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, coefficients: np.ndarray, bias: np.ndarray):
        self.languages, self.landmarks, self.coefficients, self.bias = languages, landmarks, coefficients, bias

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for at, lot in batches(texts, 1 << 18):
            parts, owner = pieces(lot)
            value = np.concatenate([
                presence(parts[i : i + 64]) @ self.landmarks @ self.coefficients
                for i in range(0, len(parts), 64)]) + self.bias
            weight = np.array([max(len(p), 1) for p in parts])[:, None]
            begin = np.searchsorted(owner, np.arange(len(lot)))
            value = np.add.reduceat(value * weight, begin) / np.add.reduceat(weight, begin)
            best = value.argmax(1)
            share = np.exp(4 * (value - value.max(1, keepdims=True)))
            share = share.max(1) / share.sum(1)
            for i, t in enumerate(lot):
                if _LETTER.search(t):
                    names[at + i], scores[at + i] = self.languages[best[i]], share[i]
        return names, scores


def spread(texts: list[str], among: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` places of different texts, by the texts' hashes."""
    first = {texts[i]: i for i in among[::-1].tolist()}
    order = sorted(first, key=lambda t: (hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), t))
    return np.array([first[t] for t in order[:count]], np.int64)


def train(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Model:
    """Landmarks are dealt evenly to the languages, and are different pieces of each."""
    kinds = sorted(set(languages))
    if not kinds:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0))
    texts, owner = pieces(texts)
    at = np.array([kinds.index(x) for x in languages])[owner]
    chosen = np.concatenate([
        spread(texts, np.flatnonzero(at == k), max(1, landmarks // len(kinds))) for k in range(len(kinds))])
    marks = presence([texts[i] for i in chosen]).T
    kernel = np.concatenate([presence(texts[i : i + 64]) @ marks for i in range(0, len(texts), 64)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    held = values > 1e-6 * values.max()
    whiten = vectors[:, held] / np.sqrt(values[held])
    x = kernel @ whiten
    y = np.where(at[:, None] == np.arange(len(kinds)), 1.0, -1.0)
    weight = 1 / np.bincount(at, minlength=len(kinds))[at][:, None]  # languages weigh alike
    weight *= len(texts) / weight.sum()
    mean_x, mean_y = (weight * x).mean(0), (weight * y).mean(0)
    centred = x - mean_x
    gram = centred.T @ (weight * centred) + ridge * len(texts) * np.eye(x.shape[1])
    solved = np.linalg.solve(gram, centred.T @ (weight * (y - mean_y)))
    return Model(kinds, marks, (whiten @ solved).astype(np.float32), mean_y - mean_x @ solved)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(documents: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train on up to about ``max_rows`` documents with a language that are not held out.
    Only these rows come to the driver; copies of a text in one language are one row."""
    known = documents.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS)
        & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    different = known.select("lang", F.xxhash64("text").alias("text")).distinct()
    counts = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], [])
    room = max(1, max_rows // len(counts))
    part = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (part < int(1_000_000 * min(1.0, room / n)) + 1))
    rows = known.where(chosen).select("text", "lang").distinct().toArrow()
    pairs = sorted(zip(rows.column("text").to_pylist(), rows.column("lang").to_pylist()))
    return train([t for t, _ in pairs], [lang for _, lang in pairs])


def identified(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns and ``lang_pred``, ``lang_score`` (0 to 1); like-named ones are replaced."""
    documents = documents.drop("lang_pred", "lang_score")
    added = StructType.fromDDL("lang_pred string, lang_score double")
    out = StructType([*documents.schema.fields, *added.fields])

    def run(lots):
        for batch in lots:
            names, scores = model.predict(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "lang_score"])

    return text_batches(documents).mapInArrow(run, out)
