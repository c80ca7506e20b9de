"""Quality of texts by naive-Bayes support vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linear
from tidemark.llm.common import mapped

#: The score from which on a text counts as good, the labelled texts of each class that are used at most, and the fold held out.
CUT, ROWS_PER_CLASS, PARTS, FOLD = 0.7, 2000, 4, 2


def features(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct hashed n-grams of each text: words and word pairs; shapes, their pairs and triples; and which share of the
    text's words has each frequent shape."""
    w = linear.Words(texts)
    h, s = w.hashes, w.shapes
    grams = [(linear.gram([h], 1), 1), (linear.gram([h[:-1], h[1:]], 2), 2), (linear.gram([s], 3), 1), (linear.gram([s[:-1], s[1:]], 4), 2), (linear.gram([s[:-2], s[1:-1], s[2:]], 5), 3)]
    scratch, out = np.zeros(linear.SIZE, np.int32), []
    for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
        n = b - a
        if not n:
            out.append(np.zeros(0, np.int64))
            continue
        parts = [g[a : b - k + 1] for g, k in grams if n >= k]
        shape, count = np.unique(s[a:b] // 6, return_counts=True)
        share = np.ceil(8 * count / n).astype(np.int64)
        parts.append(linear.gram([shape, share], 6))
        out.append(linear.indicator(np.concatenate(parts), scratch))
    return out


@dataclass(frozen=True)
class Model:
    """weights: of each feature, its log-count ratio included; then a shift, and the slope and shift of the score's curve."""

    weights: np.ndarray
    shift: float
    slope: float
    level: float

    def margins(self, found: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[f].sum() / np.sqrt(max(1, len(f))) + self.shift for f in found])

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(features(texts)) + self.level, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = np.full((2, linear.SIZE), smooth)
    for x, k in zip(rows, y, strict=True):
        counts[k, x] += 1
    totals = counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0, rounds: int = 15, seed: int = 7, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss with an L2 penalty; the shift is a constant feature of value 1."""
    w, shift = np.zeros(linear.SIZE), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    norms = np.array([(v * v).sum() + 1 for v in values])
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = sign[i] * (float(w[x] @ v) + shift) - 1
            step = min(max(alpha[i] - gradient / norms[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                w[x] += step * sign[i] * v
                shift += step * sign[i]
                largest = max(largest, abs(step))
        if largest < tolerance:
            break
    return w, shift


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """Indicators are scaled by the log-count ratios of the classes and by the text's number of features; then the linear model.

    The score's curve is fitted on margins of rows that their model hasn't seen (five parts in turn)."""
    if len(set(y.tolist())) < 2:
        slope, level = linear.platt(np.zeros(len(y)), y)
        return Model(np.zeros(linear.SIZE, np.float32), 0.0, slope, level)

    def plain(at: np.ndarray) -> tuple[np.ndarray, float]:
        own, labels = [rows[i] for i in at], y[at]
        ratio = log_count_ratios(own, labels)
        w, shift = descend(own, [ratio[x] / np.sqrt(max(1, len(x))) for x in own], labels)
        return w * ratio, shift

    part = np.arange(len(rows)) % 5
    margins = np.zeros(len(rows))
    for k in range(5):
        at = np.flatnonzero(part != k)
        if len(set(y[at].tolist())) < 2:
            continue
        w, shift = plain(at)
        for i in np.flatnonzero(part == k):
            margins[i] = w[rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) + shift
    slope, level = linear.platt(margins, y)
    w, shift = plain(np.arange(len(rows)))
    return Model(w.astype(np.float32), shift, slope, level)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """A model from at most rows_per_class texts of each label outside the held-out fold; those bounded rows come to the driver as feature numbers."""
    rows, y, _ = linear.labelled_sample(docs, labels, "quality", linear.split_remainder(PARTS) == FOLD, rows_per_class, features)
    return fit(rows, y)


def quality_scores(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """A quality score from 0 to 1 for every whole text, and whether it reaches 0.7.

    The model has a fixed size (2^18 weights), which tasks get with their code; scoring is one pass that moves no rows.

    Returns doc_id, held_out, score, predicted. Null text: the empty text, scored by the model's shift alone. Null doc_id:
    counts as the empty text for the fold. Null labels are not used; several labels of a doc_id count as their largest.
    Without labelled texts of both classes every score is the same. Repeated doc_ids: one result for each row.
    """
    return linear.scored(docs, train(docs, labels, rows_per_class), linear.split_remainder(PARTS) == FOLD, CUT)


def keep_good(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """The rows of docs, all columns, whose text's score reaches 0.7.

    Null text: scored as the empty text, and kept as null where that is good. Null or repeated doc_ids: each row is judged by its own
    text. Very long texts are scored whole. No rows: no rows; without labels of both classes all rows stay or none. Columns may have any names."""
    model = train(docs, labels, rows_per_class)
    taken = {c.lower() for c in docs.columns}
    mark = next(m for m in ("good", *(f"good_{i}" for i in range(len(taken) + 1))) if m not in taken)

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for at in range(0, batch.num_rows, 512):
                own = ["" if t is None else t for t in texts.slice(at, 512).to_pylist()]
                good = []
                for _, block in linear.text_blocks([pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int64()), pa.array(own, pa.string())], names=["i", "t"])]):
                    good += (model(block) >= CUT).tolist()
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(good, pa.bool_())], names=[*part.schema.names, mark])

    schema = docs.schema
    out = mapped(docs, judge, type(schema)([*schema.fields]).add(mark, "boolean"))
    return out.where(F.col(mark)).drop(mark)
