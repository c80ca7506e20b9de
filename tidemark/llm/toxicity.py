"""Toxicity of texts by a logistic model that is held to the same score when identity terms are swapped."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm import linear

#: The labelled texts of each class that are used at most, the fold held out, and the features that are kept at most.
ROWS_PER_CLASS, PARTS, FOLD, KEPT = 2000, 5, 0, 4096
#: First bytes of words that are features beside the whole words.
PREFIXES = (4, 5, 6)
#: Weight of the squared score change under a swap, of the squared weights, and steps of the fit.
COUNTERFACTUAL, RIDGE, STEPS = 10.0, 1e-3, 500
#: Groups of identity terms; a swap replaces each term by the next of its group.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("africans", "asians", "europeans", "americans", "arabs", "latinos"),
    ("african", "asian", "european", "american", "arab", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"), ("disabled", "deaf", "blind", "elderly"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "extranjeros"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "étrangers"),
)
#: Sentences that mention a group and say nothing about it.
MENTIONS = ("two {} were at the market", "{} neighbours came by on sunday", "the train was full of {} families")


def next_terms(groups=IDENTITY) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}


def swapped(text: bytes, groups=IDENTITY) -> bytes | None:
    """The text with every identity term replaced by the next of its group; None if it has none."""
    following = next_terms(groups)
    term = re.compile(r"\b(" + "|".join(sorted(map(re.escape, following), key=len, reverse=True)) + r")\b", re.IGNORECASE)
    out, n = term.subn(lambda m: following[m[0].lower()], text.decode())
    return out.encode() if n else None


def counterfactuals(text: bytes, groups=IDENTITY) -> list[bytes]:
    """The text and others that must score like it: with its identity terms swapped, if it has any, and with a neutral mention of a
    group added, then of the group's next. The text's hash chooses the group and the sentence, so all of them come up over many texts."""
    choice = zlib.crc32(text)
    group = groups[choice % len(groups)]
    at, sentence = choice // len(groups) % len(group), MENTIONS[choice // 4096 % len(MENTIONS)]
    mentions = [text + b" " + sentence.format(group[(at + i) % len(group)]).encode() for i in range(2)]
    other = swapped(text, groups)
    return [text, *mentions, *([text, other] if other is not None else [])]


def features(texts: list[bytes]) -> list[np.ndarray]:
    w = linear.Words(texts, PREFIXES)
    grams = [linear.gram([w.hashes], 11), *[linear.gram([p], 12 + i) for i, p in enumerate(w.prefixes)]]
    scratch = np.zeros(linear.SIZE, np.int32)
    return [linear.indicator(np.concatenate([g[a:b] for g in grams]), scratch) for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    shift: float

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        margins = np.array([float(self.weights[f].sum()) + self.shift for f in features(texts)])
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def chosen(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], kept: int = KEPT) -> np.ndarray:
    """The features that tell the classes apart best (by the z-score of their log odds), and those that a swap changes."""
    counts = np.zeros((2, linear.SIZE))
    for x, k in zip(rows, y, strict=True):
        counts[k, x] += 1
    n = np.bincount(y, minlength=2).reshape(2, 1)
    odds = np.log((counts + 0.5) / (n - counts + 0.5))
    z = np.abs(odds[1] - odds[0]) / np.sqrt((1 / (counts + 0.5) + 1 / (n - counts + 0.5)).sum(axis=0))
    z[counts.sum(axis=0) < 3] = 0
    best = np.argsort(-z, kind="stable")[:kept]
    return np.unique(np.concatenate([best[z[best] > 0], *[x for pair in pairs for x in pair]])).astype(np.int64)


def fit(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], counterfactual: float = COUNTERFACTUAL) -> Model:
    """Minimises log loss (classes weigh alike) + ridge + counterfactual * mean squared margin change of the counterfactual pairs, by
    accelerated gradient steps. pairs: the features that the first text of each has and the second hasn't, and the other way round."""
    weights = np.zeros(linear.SIZE, np.float32)
    if len(set(y.tolist())) < 2:
        return Model(weights, 0.0 if not len(y) else 4.0 if y[0] else -4.0)
    kept = chosen(rows, y, pairs)
    number = np.full(linear.SIZE, -1, np.int64)
    number[kept] = np.arange(len(kept))

    def sparse(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        own = [x[x >= 0] for x in (number[f] for f in found)]
        return np.repeat(np.arange(len(own)), [len(x) for x in own]), np.concatenate([*own, np.zeros(0, np.int64)]), len(own)

    def times(m, v: np.ndarray) -> np.ndarray:
        return np.bincount(m[0], weights=v[m[1]], minlength=m[2])

    def back(m, g: np.ndarray) -> np.ndarray:
        return np.bincount(m[1], weights=g[m[0]], minlength=len(kept))

    x, before, after = sparse(rows), sparse([p[0] for p in pairs]), sparse([p[1] for p in pairs])
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    weight = 2 * counterfactual / max(1, len(pairs))

    def penalty(v: np.ndarray) -> np.ndarray:
        """The gradient of the squared margin changes at v."""
        change = times(after, v) - times(before, v)
        return weight * (back(after, change) - back(before, change))

    # a bound on the curvature, for the step size: the largest eigenvalue, by power iteration
    v = np.ones(len(kept))
    for _ in range(20):
        v = 0.25 * back(x, share * times(x, v)) + penalty(v)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (top * 1.1 + RIDGE + 0.25)
    w = ahead = np.zeros(len(kept))
    b = ahead_b = 0.0
    for t in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(times(x, ahead) + ahead_b, -30, 30)))
        g = share * (p - y)
        gradient = back(x, g) + RIDGE * ahead + penalty(ahead)
        new, new_b = ahead - rate * gradient, ahead_b - rate * float(g.sum())
        push = t / (t + 3)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    weights[kept] = w
    return Model(weights, b)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, groups=IDENTITY, counterfactual: float = COUNTERFACTUAL) -> Model:
    """A model from at most rows_per_class texts of each label outside the held-out fold; those bounded rows come to the driver as feature numbers,
    each with what its counterfactuals change."""
    held_out = linear.split_remainder(PARTS) == FOLD
    return fit(*linear.labelled_sample(docs, labels, "toxic", held_out, rows_per_class, features, lambda text: counterfactuals(text, groups)), counterfactual)


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """A toxicity score from 0 to 1 for every whole text, and whether it reaches 0.5.

    Every labelled text gives counterfactual pairs (`counterfactuals`), so the model is held to scores that neutral mentions of groups,
    and swaps of one group for another, don't change.

    Returns doc_id, held_out, score, predicted. Null text: the empty text, scored by the model's shift alone. Null doc_id:
    counts as the empty text for the fold. Null labels are not used; several labels of a doc_id count as their largest.
    Without labelled texts of both classes every score is the same. Repeated doc_ids: one result for each row.
    """
    return linear.scored(docs, train(docs, labels, rows_per_class), linear.split_remainder(PARTS) == FOLD, 0.5)
