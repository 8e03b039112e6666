"""Quality classifier: naive Bayes weights into a linear hinge-loss model.

Indicators of word n-grams (one and two words, word shapes, and the decile of a few rates) are
hashed to 2^18 columns, scaled by the log ratio of their class counts, normalised per text,
and fitted by dual coordinate descent (L2-regularised hinge loss). Margins of a quarter of the
training rows give the logistic calibration. At most TRAIN_ROWS labelled documents outside the
held-out fold are learned from, picked by hash; their hashed indicators fit the driver by that
bound. Everything is scored.

Null and empty texts have no n-grams and get the score of an empty vector. Without both classes
the score is the share of label 1. Repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlewatch.llm.common import BASE, chunks, held_out, mixed, training_labels, word_spans

TRAIN_ROWS = 6_000
BITS = 18
SIZE = 1 << BITS


def indicators(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct columns of each text."""
    words, owner, start, end, raw = word_spans(texts)
    first, last = raw[start], raw[end - 1]

    def upper(b):
        return (b >= 65) & (b <= 90)

    def letter(b):
        return upper(b) | ((b >= 97) & (b <= 122)) | (b >= 128)

    shape = (
        upper(first).astype(np.uint64) + np.uint64(2) * upper(last) + np.uint64(4) * letter(first) + np.uint64(8) * letter(last)
        + np.uint64(16) * np.minimum(end - start, 15).astype(np.uint64)
    )
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    next_in = owner[1:] == owner[:-1]
    pair = (words[:-1] * BASE + words[1:])[next_in]
    shapes = ((shape[:-1] << np.uint64(16)) + shape[1:])[next_in]
    counts = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
    parts, owners = [words, mixed(pair), mixed(shapes + np.uint64(1 << 40))], [owner, owner[1:][next_in], owner[1:][next_in]]
    rates = (again, upper(first), upper(last), ~letter(last), ~letter(first))
    here = np.unique(owner)
    for k, flag in enumerate(rates):
        rate = np.bincount(owner, weights=flag, minlength=len(texts)) / counts
        parts.append(mixed(np.floor(rate * 20).astype(np.uint64) + np.uint64((2 + k) << 44))[here])
        owners.append(here)
    parts.append(mixed(np.log2(counts).astype(np.uint64) + np.uint64(1 << 43))[here])
    owners.append(here)
    ids, owners = np.concatenate(parts) & np.uint64(SIZE - 1), np.concatenate(owners)
    both = np.unique(owners.astype(np.int64) << BITS | ids.astype(np.int64))
    return np.split(both & (SIZE - 1), np.searchsorted(both >> BITS, np.arange(1, len(texts))))


class Model:
    def __init__(self, ratio: np.ndarray, weights: np.ndarray, slope: float, base: float):
        self.ratio, self.weights, self.slope, self.base = ratio, weights, slope, base

    def score(self, ids: np.ndarray) -> float:
        x = vector(ids, self.ratio)
        return float(1 / (1 + np.exp(-(self.slope * margin(ids, x, self.weights) + self.base))))


def vector(ids: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    x = ratio[ids]
    return x / (np.sqrt(x @ x) or 1.0)


def margin(ids, x, weights) -> float:
    return float(weights[ids] @ x + weights[-1])


def fitted(rows: list[np.ndarray], labels: np.ndarray, cost: float = 4.0, epochs: int = 12) -> Model:
    """Dual coordinate descent over three quarters of the rows, calibration on the rest."""
    share = float(labels.mean()) if len(labels) else 0.0
    fit = np.arange(len(rows)) % 4 != 3
    if len(set(labels[fit])) < 2 or len(set(labels[~fit])) < 2:
        fit = np.ones(len(rows), bool)
    if len(set(labels)) < 2:
        return Model(np.zeros(SIZE), np.zeros(SIZE + 1), 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    counts = np.ones((2, SIZE))
    for i in np.flatnonzero(fit):
        counts[labels[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    vectors = [vector(ids, ratio) for ids in rows]
    weights, alpha = np.zeros(SIZE + 1), np.zeros(len(rows))
    sign = 2.0 * labels - 1
    used, rng = np.flatnonzero(fit), np.random.default_rng(5)
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) * cost
    for _ in range(epochs):
        for i in rng.permutation(used):
            ids, x = rows[i], vectors[i]
            slope = sign[i] * margin(ids, x, weights) - 1
            new = min(max(alpha[i] - slope / (float(x @ x) + 1), 0.0), balance[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[ids] += step * x
                weights[-1] += step
                alpha[i] = new
    check = np.flatnonzero(~fit) if not fit.all() else used
    m = np.array([margin(rows[i], vectors[i], weights) for i in check])
    y, design = labels[check], np.c_[m, np.ones(len(m))]
    theta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hess, design.T @ (p - y) + 1e-3 * theta), -2, 2)
    return Model(ratio, weights, *map(float, theta))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def ids_of(batches):
        for batch in batches:
            for first, texts in chunks(batch):
                ids = [x.astype("<i4").tobytes() for x in indicators(texts)]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["label"], pa.array(ids, pa.binary())], names=["doc_id", "label", "ids"])

    picked = training_labels(labels, label, rows)
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id")
    table = train.mapInArrow(ids_of, "doc_id long, label int, ids binary").toArrow().sort_by("doc_id")
    model = fitted([np.frombuffer(x, "<i4").astype(np.int64) for x in table["ids"].to_pylist()], np.array(table["label"].to_pylist(), np.int64))
    known = docs.sparkSession.sparkContext.broadcast(model)  # two vectors of 2^18 numbers

    def score(batches):
        for batch in batches:
            for first, texts in chunks(batch):
                scores = [known.value.score(ids) for ids in indicators(texts)]
                yield pa.RecordBatch.from_arrays([batch.slice(first, len(texts))["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
