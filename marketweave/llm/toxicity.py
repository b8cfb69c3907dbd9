"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the distinct hashes of its lower-cased words (runs of ASCII letters,
digits and non-ASCII characters), of its pairs of neighbouring words and of its pairs with one
word between, folded into 2**20 coordinates. FTRL-proximal gives every coordinate its own
learning rate and sets coordinates without enough evidence to exactly zero, so the model
is a short list of (coordinate, weight), at most 2**20 of them: small enough to broadcast.

Training takes a bounded sample of labelled rows (``max_rows``, chosen by a hash of the id)
in one task; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.llm import words as wd

BITS = 20
# Labelled rows to learn from: the ones with the smallest id hashes.
MAX_ROWS = 20_000
_FOLD = np.full(256, 0x20, dtype=np.uint8)
for _b in range(256):
    if chr(_b).isascii() and chr(_b).isalnum() or _b >= 0x80:
        _FOLD[_b] = _b + 32 if 65 <= _b <= 90 else _b
_SKIP = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Model:
    """Non-zero weights by coordinate, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, coordinate)`` of every word, pair and skip-pair (with repeats)."""
    h, _, _, first = wd.words(_FOLD[raw], offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    rows, coords = [row], [h]
    for gap, salt in ((1, np.uint64(0)), (2, _SKIP)):
        same = row[:-gap] == row[gap:]
        with np.errstate(over="ignore"):
            pair = wd.mix(h[:-gap] * wd._STEP[0] + h[gap:] * wd._STEP[1] + salt)
        rows.append(row[:-gap][same])
        coords.append(pair[same])
    return np.concatenate(rows), (np.concatenate(coords) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal for binary features; the last coordinate is the bias (no L1)."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0):
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
        self.l1 = np.full((1 << BITS) + 1, l1)
        self.l1[-1] = 0.0

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, coords: np.ndarray, label: float) -> None:
        at = np.append(coords, 1 << BITS)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        root = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (root - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", *,
          keep: Column | None = None, max_rows: int = MAX_ROWS, epochs: int = 5) -> Model:
    """Fit on the texts of ``docs`` whose id is labelled (``keep`` narrows the label rows).

    Of several labels of one id the largest counts; null labels, null ids and ids without a
    document teach nothing; without any row the model is empty and scores 0.5. Only text and
    label are read."""
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if keep is not None:
        rows = rows.filter(keep)
    picked = (rows.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
              .groupBy("doc_id", "y").agg(F.max("text").alias("text"))
              .select("text", "y", F.xxhash64("doc_id", F.lit("order")).alias("turn"), "doc_id"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, float]] = []
        for batch in batches:
            y = batch.column(1).to_numpy()
            for a, b, raw, off in wd.chunks(batch.column(0)):
                row, coord = features(raw, off)
                pair = np.unique(row << BITS | coord)
                cut = np.searchsorted(pair, np.arange(b - a + 1) << BITS)
                for i in range(b - a):
                    own = pair[cut[i]:cut[i + 1]] & ((1 << BITS) - 1)
                    seen.append((own.astype(np.int32), float(y[a + i])))
        m = Ftrl()
        for _ in range(epochs):
            for coords, label_value in seen:
                m.learn(coords, label_value)
        w = m.weights(slice(None))
        at = np.append(np.flatnonzero(w[:-1]), 1 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["i", "w"])

    # one task: at most max_rows texts; the order of learning is fixed by the hash
    got = (sample.repartition(1).sortWithinPartitions("turn", "doc_id")
           .select("text", "y").mapInArrow(fit, "i long, w double").collect())
    weights = {r["i"]: r["w"] for r in got}
    bias = weights.pop(1 << BITS, 0.0)
    at = np.array(sorted(weights), dtype=np.int64)
    return Model(at, np.array([weights[i] for i in at.tolist()]), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs``: the probability of label 1.

    Null and empty texts score the bias alone; repeated rows are scored each; long texts are
    read whole; other columns are ignored; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[shared.value.index] = shared.value.weight
        for batch in batches:
            key = batch.column(0)
            for a, b, raw, off in wd.chunks(batch.column(1)):
                row, coord = features(raw, off)
                hit = table[coord] != 0
                pair = np.unique(row[hit] << BITS | coord[hit])
                total = shared.value.bias + np.bincount(
                    pair >> BITS, table[pair & ((1 << BITS) - 1)], minlength=b - a)
                p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([key.slice(a, b - a), pa.array(p)],
                                                 ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
