"""Toxicity by logistic regression over hashed n-grams and skip-grams, trained by FTRL-proximal.

Features of a text are the hashes of its words and of their stems, of neighbouring pairs and of pairs
with one word between, each counted once. Training runs over a bounded sample of labelled rows, in a fixed order;
per-coordinate rates and L1 leave few weights, which travel to the scoring tasks with their closure.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Ftrl:
    """``max_rows`` bounds the labelled rows that training sees, ``bits`` the number of weights."""

    max_rows: int = 8000
    bits: int = 18
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 0.1
    epochs: int = 4
    folds: int = 5


class Hasher:
    """Feature numbers of texts; remembers word hashes, up to a limit."""

    HELD, STEM = 500_000, 5

    def __init__(self, bits: int) -> None:
        self.mask, self.known = np.uint64((1 << bits) - 1), {}

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words, and of their stems: a word's first letters."""
        if len(self.known) > self.HELD:
            self.known.clear()
        known, found = self.known, WORD.findall(text.lower())
        for word in set(found).difference(known):
            stem = zlib.crc32(word[: self.STEM].encode(), 1)
            known[word] = zlib.crc32(word.encode()) << 32 | stem
        both = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        return both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)

    def __call__(self, text: str | None) -> np.ndarray:
        h, stems = self.words(text or "")
        factor = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio in 64 bits
        pair = lambda a, b, kind: (a * factor + b + np.uint64(kind)) * factor
        unigrams = [h * factor, stems * factor]
        grams = np.concatenate([*unigrams, pair(h[:-1], h[1:], 1), pair(h[:-2], h[2:], 2)])
        return np.unique((grams >> np.uint64(24)) & self.mask).astype(np.int64)


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def train(rows: list[tuple[np.ndarray, int]], p: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature numbers, their weights, bias) after ``epochs`` passes over ``rows`` in order."""
    size = 1 << p.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias, without L1
    bias = np.array([size])

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, p.l1)
        shrunk = np.sign(z[at]) * l1 - z[at]
        return np.where(np.abs(z[at]) <= l1, 0.0, shrunk / ((p.beta + np.sqrt(n[at])) / p.alpha + p.l2))

    for _ in range(p.epochs):
        for features, label in rows:
            at = np.concatenate([features, bias])
            w = weights(at)
            gradient = sigmoid(w.sum()) - label
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / p.alpha
            z[at] += gradient - step * w
            n[at] += gradient**2
    everything = weights(np.arange(size + 1))
    used = np.flatnonzero(everything[:size])
    return used, everything[used], float(everything[size])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training, by CRC32 of its doc_id as text; a null is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, p: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """The model from a bounded sample of labelled rows outside the held-out fold."""
    known = (
        labels.filter(~held_out(F.col("doc_id"), p.folds) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = spill(known, "labels")
    share = min(1.0, p.max_rows / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit("ftrl"), "labelled"), F.lit(1 << 40))
    chosen = known.filter(draw < int(share * (1 << 40)))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Hasher(p.bits)
        for batch in all_slices(batches, "text"):
            found = [features(t).astype(np.int32) for t in batch["text"].to_pylist()]
            columns = [batch["draw"], batch["toxic"], pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["draw", "toxic", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            arrays = [x.values.to_numpy() for x in batch["features"]]
            rows += zip(batch["draw"].to_pylist(), arrays, batch["toxic"].to_pylist(), strict=True)
        rows.sort(key=lambda r: (r[0], len(r[1]), r[2]))
        used, weights, bias = train([(f.astype(np.int64), y) for _, f, y in rows], p)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1], pa.int64()), pa.array([*weights, bias], pa.float64())],
            names=["feature", "weight"],
        )

    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("labelled"))
    rows = rows.select("text", draw.alias("draw"), "toxic")
    sample = spill(rows.mapInArrow(extract, "draw long, toxic int, features array<int>"), "sample")
    # One task: the sample is bounded by max_rows.
    model = sample.repartition(1).mapInArrow(learn, "feature long, weight double").collect()
    used = sorted((r.feature, r.weight) for r in model if r.feature >= 0)
    bias = next((r.weight for r in model if r.feature < 0), 0.0)
    return np.array([f for f, _ in used], int), np.array([w for _, w in used], float), bias


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and toxic; a document labelled twice counts once, as toxic if either says
    so. Null labels are left out, null doc_ids are never trained on and are held out. A null text is
    scored as an empty one: by the bias. Without labelled rows every score is 0.5. Repeated rows
    score alike; an empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    used, weights, bias = fit(docs, labels, p)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, dense = Hasher(p.bits), np.zeros(1 << p.bits)
        dense[used] = weights
        for batch in all_slices(batches, "text"):
            scores = [sigmoid(dense[features(t)].sum() + bias) for t in batch["text"].to_pylist()]
            columns = [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id"), p.folds).alias("held_out"), "text")
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
