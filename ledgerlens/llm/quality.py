"""Quality classifier: Naive Bayes support vectors.

Indicator n-grams are scaled by the log ratio of their smoothed class counts,
the scaled rows are normalised, and a linear hinge-loss model is fitted by dual
coordinate descent.  A logistic map of the margin (fitted on training rows that
the descent did not see) turns it into a score from 0 to 1.

The n-grams of a text are its byte pairs and triples, its words, its word pairs
and two equality patterns (a word repeated twice, three times in a row).  Byte
pairs have slots of their own; triples and words are hashed to ``2**BITS`` slots
each.  Only the text is read.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows (the smallest by hash of
doc_id), a documented bound: their ids are broadcast, so no text is shuffled.
Scoring is one pass over whole texts with two broadcast arrays of SLOTS floats.

Defined results: a null text counts as empty; an empty text has no n-grams and
gets the score of the bias; rows with a null label or doc_id are not learned
from; several labels of one doc_id count as their minimum; repeated documents
are scored row by row; very long texts are read whole; without labels of both classes the score is the smoothed
share of label 1 (0.5 without any label); extra columns are ignored by
``score`` and carried by ``filter_predicted``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import MULT, arrow_map, as_bytes, column_bytes, hashed_sample, word_hashes

BITS = 17
SLOTS = (1 << 16) + (2 << BITS) + 8
_TRIPLES, _WORDS = 1 << 16, (1 << 16) + (1 << BITS)
SAMPLE_ROWS = 4000
THRESHOLD = 0.7
ALPHA = 1.0
SMOOTH = 30.0  # added to the squared norms: a text of few n-grams stays near the bias
COST = 4.0
EPOCHS = 30
_U = np.uint64
_SHIFT = _U(64 - BITS)


def held_out(doc_id):
    """Rows that no label is learned from: crc32 of the id's digits leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def slots(text: bytes | None) -> np.ndarray:
    """Sorted distinct slots of the n-grams of one text."""
    b = as_bytes(text)
    if not len(b):
        return np.zeros(0, dtype=np.int32)
    seen = np.zeros(SLOTS, dtype=bool)
    if len(b) > 1:
        pair = (b[:-1].astype(np.uint32) << np.uint32(8)) | b[1:]
        seen[pair] = True
        seen[_TRIPLES + (((pair[:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))] = True
    w = word_hashes(b)
    seen[_WORDS + (w >> _SHIFT).astype(np.int64)] = True
    if len(w) > 1:
        seen[_WORDS + (((w[:-1] * MULT) ^ w[1:]) * MULT >> _SHIFT).astype(np.int64)] = True
        twice = w[1:] == w[:-1]
        if twice.any():
            seen[SLOTS - 2] = True
            seen[SLOTS - 1] = (twice[1:] & twice[:-1]).any()
    octets = np.flatnonzero(seen.view(np.uint64))  # most are empty: look at eight slots at a time
    row, column = np.nonzero(seen.reshape(-1, 8)[octets])
    return (octets[row] * 8 + column).astype(np.int32)


@dataclass
class NBSVM:
    """weight: log ratio times fitted coefficient; ratio: for the row norms; a, b: logistic map."""
    weight: np.ndarray
    ratio2: np.ndarray
    bias: float
    a: float
    b: float

    def margin(self, s: np.ndarray) -> float:
        if not len(s):
            return self.bias
        norm = math.sqrt(float(self.ratio2[s].sum()) + SMOOTH)
        return float(self.weight[s].sum()) / norm + self.bias

    def score(self, s: np.ndarray) -> float:
        return _sigmoid(self.a * self.margin(s) + self.b)


def _sigmoid(z: float) -> float:
    if z >= 0:
        return 1.0 / (1.0 + math.exp(-z))
    e = math.exp(z)
    return e / (1.0 + e)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """log of the smoothed, normalised indicator counts of label 1 over those of label 0."""
    counts = np.full((2, SLOTS), alpha)
    for s, label in zip(rows, y):
        counts[int(label), s] += 1.0
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray,
                            cost: np.ndarray, epochs: int = EPOCHS, seed: int = 7,
                            tol: float = 1e-2) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model: one dual variable a row, each step solves its own exactly.

    minimises 1/2 |w|^2 + sum_i cost_i * max(0, 1 - y_i (w.x_i + bias)), the bias
    being the weight of a constant column; y is -1 or 1.
    """
    w = np.zeros(SLOTS, dtype=np.float32)
    bias = 0.0
    alpha = np.zeros(len(rows))
    q = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    moved = np.ones(len(rows), dtype=bool)
    for epoch in range(epochs):
        worst = 0.0
        visit = np.arange(len(rows)) if epoch % 5 == 0 else np.flatnonzero(moved)  # between full passes, rows that still move
        moved[:] = False
        for i in rng.permutation(visit):
            s, v = rows[i], values[i]
            g = y[i] * (float(w[s] @ v) + bias) - 1.0
            step = g if 0.0 < alpha[i] < cost[i] else min(g, 0.0) if alpha[i] <= 0.0 else max(g, 0.0)
            if step == 0.0:
                continue
            worst = max(worst, abs(step))
            moved[i] = True
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            d = (new - alpha[i]) * y[i]
            alpha[i] = new
            w[s] += d * v
            bias += d
        if epoch % 5 == 0 and worst < tol:
            break
    return w, bias


def _logistic_map(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Newton's method for the two coefficients, with smoothed targets so that separable rows stay finite."""
    pos, neg = float((y == 1).sum()), float((y == 0).sum())
    if not pos or not neg:
        return 1.0, math.log((pos + 1) / (neg + 1))
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float(d @ margins) + 1e-3 * a, float(d.sum())
        haa, hab, hbb = float(h @ margins**2) + 1e-3, float(h @ margins), float(h.sum()) + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if max(abs(da), abs(db)) < 1e-6:
            break
    return a, b


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> NBSVM:
    """The model of one bounded sample; the order of the rows is fixed by the caller."""
    y = np.asarray(labels, dtype=np.int64)
    zero = np.zeros(SLOTS, dtype=np.float32)
    pos, neg = int((y == 1).sum()), int((y == 0).sum())
    if not pos or not neg:
        return NBSVM(zero, zero, 0.0, 1.0, math.log((pos + 1) / (neg + 1)) if len(y) else 0.0)
    ratio = log_count_ratio(rows, y)
    # Every fifth row of each class is kept for the logistic map, if a class has five.
    rank = np.zeros(len(y), dtype=np.int64)
    for c in (0, 1):
        rank[y == c] = np.arange((y == c).sum())
    calib = (rank % 5 == 4) if min(pos, neg) >= 5 else np.zeros(len(y), dtype=bool)
    index = np.flatnonzero(~calib)
    sign = np.where(y == 1, 1.0, -1.0)

    def row_values(s):
        v = ratio[s]
        return (v / math.sqrt(float(v @ v) + SMOOTH)).astype(np.float32)

    cost = np.full(len(index), COST)
    w, bias = dual_coordinate_descent([rows[i] for i in index], [row_values(rows[i]) for i in index],
                                      sign[index], cost)
    model = NBSVM((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, 1.0, 0.0)
    use = np.flatnonzero(calib) if calib.any() else index
    model.a, model.b = _logistic_map(np.array([model.margin(rows[i]) for i in use]), y[use])
    return model


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> NBSVM:
    """Learn from the labelled rows outside the held-out remainder, at most ``sample_rows`` of them.

    Of the rows that share a sampled doc_id one is used, the one of smallest features.
    """
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    chosen = hashed_sample(usable, "doc_id", sample_rows)
    texts = (documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
             .join(F.broadcast(chosen), "doc_id"))  # at most sample_rows rows of two numbers

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        blobs = [slots(t).tobytes() for t in column_bytes(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(blobs, pa.binary())],
                                          ["doc_id", "label", "slots"])
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, slots binary"
    # One row a doc_id, combined before it moves: what reaches the driver is bounded by rows, also where a doc_id repeats.
    one = arrow_map(texts.select("doc_id", "label", "text"), encode, schema).groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min("slots").alias("slots"))
    got = one.toArrow().to_pydict()
    rows = [np.frombuffer(x, dtype=np.int32) for x in got["slots"]]
    order = sorted(range(len(rows)), key=lambda i: (got["doc_id"][i], got["slots"][i]))
    return fit_rows([rows[i] for i in order], np.array([got["label"][i] for i in order]))


def _scores(batch: pa.RecordBatch, model: NBSVM) -> list[float]:
    return [model.score(slots(t)) for t in column_bytes(batch.column("text"))]


def score(documents: DataFrame, model: NBSVM, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = np.array(_scores(batch, held.value), dtype=np.float64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
              "score double, predicted int")
    return arrow_map(rows, run, schema)


def filter_predicted(documents: DataFrame, model: NBSVM, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` (all their columns) whose score reaches the threshold."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([x >= threshold for x in _scores(batch, held.value)]))
    return arrow_map(documents, run, documents.schema)
