"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

Features are the character n-grams of a text, hashed into buckets. Each bucket is scaled
by its naive Bayes log-count ratio: how much more often toxic than other training texts
have it. A logistic regression with weight decay on the scaled features gives the score.

Texts are cut into overlapping segments of ``SEGMENT`` characters, all of which are
scored; a text is as toxic as its worst segment. So a short insult weighs the same in a
long text as in a short one. A toxic training text is stood for by its worst segment, as
is a clean one by its worst few: by the naive Bayes sums at first, then by the model.

Training rows are a bounded sample: up to ``MAX_ROWS`` labelled texts of up to
``MAX_CHARS`` characters, chosen by a hash. All else covers every text whole.

Defined results. Null and empty texts are scored as texts without n-grams. Null labels and
null texts are not learned from. Without both classes among the labels, every score is the
share of toxic labels (0 without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .chargrams import batches, code_points, gram_buckets
from .storage import text_batches

BITS = 18
SIZES = (3, 4, 5, 6)
SEGMENT = 256
MAX_ROWS = 2400
MAX_CHARS = 20_000
LEAST_TEXTS = 3


def _segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last place of half-overlapping segments."""
    step = SEGMENT // 2
    counts = np.maximum(-(-np.diff(offsets) // step) - 1, 1)
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = offsets[text] + nth * step
    return text, first, np.minimum(first + SEGMENT, offsets[text + 1])


class Model:
    """Weights per bucket, and the scale from the worst segment's sum to a probability."""

    def __init__(self, weights: np.ndarray, scale: float, bias: float):
        self.weights, self.scale, self.bias = weights.astype(np.float32), scale, bias

    def worst(self, texts: list) -> np.ndarray:
        """Sum of the worst segment of each text."""
        out = np.zeros(len(texts))
        for at, lot in batches(texts):
            points, offsets = code_points(lot)
            text, first, last = _segments(offsets)
            total = np.zeros(len(text))
            for n, bucket in gram_buckets(points, SIZES, BITS):
                sums = np.zeros(len(bucket) + 1)
                np.cumsum(self.weights[bucket], out=sums[1:])
                a = np.minimum(first, len(bucket))
                b = np.clip(last - n + 1, a, len(bucket))
                total += sums[b] - sums[a]
            begin = np.searchsorted(text, np.arange(len(lot)))
            out[at : at + len(lot)] = np.maximum.reduceat(total, begin)
        return out

    def scores(self, texts: list) -> np.ndarray:
        z = np.clip(self.worst(texts) * self.scale + self.bias, -35, 35)
        return 1 / (1 + np.exp(-z))


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, bucket) of every n-gram, and the text of each segment."""
    points, offsets = code_points(texts)
    text, first, last = _segments(offsets)
    rows, columns = [], []
    for n, bucket in gram_buckets(points, SIZES, BITS):
        width = np.maximum(np.minimum(last - n + 1, len(bucket)) - first, 0)
        seg = np.repeat(np.arange(len(text)), width)
        place = np.arange(len(seg)) - np.repeat(np.cumsum(width) - width, width) + first[seg]
        rows.append(seg.astype(np.int32))
        columns.append(bucket[place].astype(np.int32))
    return np.concatenate(rows), np.concatenate(columns), text


def _ratios(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """Log of how much likelier a toxic text is to have the bucket's n-grams."""
    having = np.zeros((2, 1 << BITS))
    for at, lot in batches(texts, 1 << 20):
        points, offsets = code_points(lot)
        for n, bucket in gram_buckets(points, SIZES, BITS):
            place = np.searchsorted(offsets, np.arange(len(bucket)), "right") - 1
            inside = np.arange(len(bucket)) + n <= offsets[place + 1]
            pairs = np.unique(place[inside] << BITS | bucket[inside])
            kind = toxic[at + (pairs >> BITS)]
            for k in (0, 1):
                having[k] += np.bincount(pairs[kind == k] & ((1 << BITS) - 1), minlength=1 << BITS)
    share = (having + 1) / (np.bincount(toxic, minlength=2)[:, None] + 2)
    ratio = np.log(share[1] / share[0])
    ratio[having.sum(0) < LEAST_TEXTS] = 0
    return ratio


def train(texts: list[str], toxic, rounds: int = 2, steps: int = 40, decay: float = 1e-3) -> Model:
    """Fit on labelled texts (1: toxic). The scale from sums to probabilities comes from
    sums of each half by weights learned from the other half."""
    toxic = np.asarray(toxic, np.int64)
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS), 0.0, -35.0 if share == 0 else 35.0)
    model = Model(_weights(texts, toxic, rounds, steps, decay), 1.0, 0.0)
    half = np.zeros(len(toxic), bool)
    for kind in (0, 1):  # every other text of each class
        half[np.flatnonzero(toxic == kind)[::2]] = True
    sums = np.zeros(len(toxic))
    for side in (half, ~half):
        own, rest = np.flatnonzero(side), np.flatnonzero(~side)
        if len(set(toxic[own])) < 2 or len(set(toxic[rest])) < 2:
            sums = model.worst(texts)
            break
        part = Model(_weights([texts[i] for i in rest], toxic[rest], rounds, steps, decay), 1.0, 0.0)
        sums[own] = part.worst([texts[i] for i in own])
    model.scale, model.bias = _scale(sums, toxic)
    return model


def _weights(texts: list[str], toxic: np.ndarray, rounds: int, steps: int, decay: float) -> np.ndarray:
    ratio = _ratios(texts, toxic)
    weights = np.where(ratio > 0, ratio, 0)  # rounds begin from what speaks for toxic
    for _ in range(rounds):
        rows, columns, label = [], [], []
        n_rows = 0
        for at, lot in batches(texts, 1 << 20):
            seg, bucket, text = _features(lot)
            total = np.bincount(seg, weights[bucket], len(text))
            order = np.lexsort((-total, text))
            rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
            keep = order[rank < np.where(toxic[at + text[order]] == 1, 1, 2)]
            number = np.full(len(text), -1)
            number[keep] = np.arange(len(keep))
            mine = number[seg] >= 0
            rows.append(number[seg[mine]] + n_rows)
            columns.append(bucket[mine])
            label.append(toxic[at + text[keep]])
            n_rows += len(keep)
        rows, columns, label = np.concatenate(rows), np.concatenate(columns), np.concatenate(label)
        weights = _fit(rows, columns, label, ratio, steps, decay)
    return weights


def _fit(rows, columns, label, ratio, steps, decay) -> np.ndarray:
    """Logistic regression on scaled n-gram counts; both classes weigh the same."""
    n = len(label)
    value = ratio[columns]
    used = value != 0
    rows, columns, value = rows[used], columns[used], value[used]
    norm = 1 / np.sqrt(SEGMENT * len(SIZES))
    value = value * norm
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    # start from naive Bayes itself: every scaled feature counts alike
    coef, bias = np.full(len(ratio), 1.0), 0.0
    first, second, b1, b2 = np.zeros(len(ratio)), np.zeros(len(ratio)), 0.0, 0.0
    bias = -np.median(np.bincount(rows, value * coef[columns], n))
    for t in range(1, steps + 1):
        z = np.bincount(rows, value * coef[columns], n) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - label)
        grad = np.bincount(columns, value * error[rows], len(ratio)) + decay * coef / n
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        coef -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
        g = error.sum()
        b1, b2 = 0.9 * b1 + 0.1 * g, 0.99 * b2 + 0.01 * g * g
        bias -= 0.1 * (b1 / (1 - 0.9**t)) / (np.sqrt(b2 / (1 - 0.99**t)) + 1e-6)
    return coef * ratio * norm


def _scale(worst: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through the worst sums."""
    mid = worst.mean()
    spread = worst.std() or 1.0
    x = (worst - mid) / spread
    weight = 1 / len(toxic)
    a, b = 1.0, 0.0
    for _ in range(1000):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        a -= 2.0 * ((weight * (p - toxic) * x).sum() + 1e-4 * a)
        b -= 2.0 * (weight * (p - toxic)).sum()
    return float(a / spread), float(b - a * mid / spread)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train on up to about ``max_rows`` labelled documents that are not held out, a quarter
    of them toxic or as many as there are. Only these rows come to the driver."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    room = {1: max_rows // 4, 0: max_rows - max_rows // 4}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    chosen = None
    for kind, n in counts.items():
        rows = known.where((F.col("toxic") == kind) & (part < int(1_000_000 * min(1.0, room[kind] / n))))
        chosen = rows if chosen is None else chosen.union(rows)
    if chosen is None:
        return train([], [])
    # about max_rows ids of 12 bytes: small enough to send whatever the input
    rows = (
        documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS))
        .join(F.broadcast(chosen), "doc_id").select("text", "toxic").toArrow()
    )
    texts, toxic = rows.column("text").to_pylist(), rows.column("toxic").to_pylist()
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))  # the same model for any layout
    return train([texts[i] for i in order], [toxic[i] for i in order])


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns and ``score`` (0 to 1) and ``predicted`` (1 from 0.5); like-named ones are replaced."""
    documents = documents.drop("score", "predicted")
    out = StructType([*documents.schema.fields, *StructType.fromDDL("score double").fields])

    def run(lots):
        for batch in lots:
            score = pa.array(model.scores(batch.column(text).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    return text_batches(documents).mapInArrow(run, out).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
