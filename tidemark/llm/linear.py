"""Features and fitting that the text classifiers share: hashed indicators of words, shapes and their n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MASK, _FOLD, _IS_SPACE, _STEP, _byte_codes, _powers, mapped, mix, text_blocks

#: Hashed features.
BITS = 18
SIZE = 1 << BITS


class Words:
    """The words of a block of texts: hashes of the whole words and of their first bytes, shapes, and each text's share."""

    def __init__(self, texts: list[bytes], prefixes: tuple[int, ...] = ()) -> None:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _IS_SPACE[raw]
        inside = ~space
        first = inside.copy()
        first[1:] &= space[:-1]
        starts = np.flatnonzero(first)
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.offsets = np.concatenate([[0], np.searchsorted(starts, text_ends)])
        n = len(starts)
        self.prefixes: list[np.ndarray] = []
        if not n:
            self.hashes = np.zeros(0, np.uint64)
            self.shapes = np.zeros(0, np.int64)
            self.prefixes = [self.hashes for _ in prefixes]
            return
        cum = np.cumsum(inside)
        at = np.concatenate([[0], cum])[starts]
        lengths = np.diff(np.append(at, cum[-1]))
        raw = raw[inside]
        position = np.arange(len(raw)) - np.repeat(at, lengths)
        longest = int(lengths.max())
        codes = _byte_codes()[_FOLD[raw]] * _powers(1 << max(6, (longest - 1).bit_length()))[position]
        self.hashes = mix(np.add.reduceat(codes, at) + lengths.astype(np.uint64) * _STEP)
        for p in prefixes:
            own = np.where(position < p, codes, np.uint64(0))
            self.prefixes.append(mix(np.add.reduceat(own, at) + np.uint64((1000 + p) * int(_STEP) & MASK)))
        # shape: share of capitals, of digits, of other ASCII signs, whether the word is the one before, and its length
        upper = np.add.reduceat((raw >= 65) & (raw <= 90), at, dtype=np.int64)
        digit = np.add.reduceat((raw >= 48) & (raw <= 57), at, dtype=np.int64)
        low = raw | 32
        sign = np.add.reduceat((raw < 128) & ~((low >= 97) & (low <= 122)) & ~((raw >= 48) & (raw <= 57)), at, dtype=np.int64)
        part = lambda x: np.minimum(2, (2 * x + lengths - 1) // lengths)  # noqa: E731  none, up to half, more
        same = np.zeros(n, np.int64)
        same[1:] = self.hashes[1:] == self.hashes[:-1]
        same[self.offsets[:-1][self.offsets[:-1] < n]] = 0
        long = np.digitize(lengths, (3, 7, 13, 26, 60))
        self.shapes = ((((part(upper) * 3 + part(digit)) * 4 + np.minimum(sign, 3)) * 3 + part(sign)) * 2 + same) * 6 + long


def gram(parts: list[np.ndarray], tag: int) -> np.ndarray:
    """Feature numbers of the n-grams whose members stand in `parts`."""
    out = np.full(len(parts[0]), tag, np.uint64)
    for p in parts:
        out = out * np.uint64(0xD1B54A32D192ED03) + p.astype(np.uint64)
    return (mix(out) >> np.uint64(64 - BITS)).astype(np.int64)


def indicator(features: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The distinct features of a text. scratch: SIZE numbers, whatever they hold."""
    order = np.arange(len(features), dtype=scratch.dtype)
    scratch[features] = order
    return features[scratch[features] == order]


def split_remainder(parts: int) -> Column:
    """crc32 of doc_id as text, modulo `parts`; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows_per_class: int, features, variants=None) -> tuple[list[np.ndarray], np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Distinct features and labels of at most rows_per_class labelled texts of each class, those of smallest hash, outside the
    held-out fold; and for each two neighbours of what `variants` makes of a text, the features that only the first and only the second
    has. The sampled ids are bounded by that parameter, so they are broadcast to a scan of the documents. Of several texts
    of a doc_id the smallest counts (a null text, as the empty one, if all are null), so the rows are bounded too."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = usable.where("y = 0").orderBy(*order).limit(rows_per_class).unionByName(usable.where("y = 1").orderBy(*order).limit(rows_per_class))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))

    def run(batches):
        packed = lambda x: x.astype(np.int32).tobytes()
        for batch in batches:
            ys = batch.column(2).to_pylist()
            seen = 0
            for ids, own in text_blocks([batch]):
                changes = []
                for t in own:
                    chain = features(variants(t)) if variants else []
                    changes.append([packed(x) for a, b in zip(chain, chain[1:]) for x in (np.setdiff1d(a, b), np.setdiff1d(b, a))])
                x = [packed(f) for f in features(own)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys[seen : seen + len(ids)], pa.int32()), pa.array(x, pa.binary()), pa.array(changes, pa.list_(pa.binary()))], names=["doc_id", "y", "x", "changes"])
                seen += len(ids)

    source = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y")
    rows = sorted((r.doc_id, r.y, bytes(r.x), [bytes(c) for c in r.changes]) for r in mapped(source, run, "doc_id long, y int, x binary, changes array<binary>").collect())
    numbers = lambda data: np.frombuffer(data, np.int32).astype(np.int64)
    pairs = [(numbers(a), numbers(b)) for r in rows for a, b in zip(r[3][::2], r[3][1::2], strict=True)]
    return [numbers(r[2]) for r in rows], np.array([r[1] for r in rows], np.int64), pairs


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton steps on smoothed targets; a constant when a class is missing."""
    if len(set(y.tolist())) < 2:
        return 0.0, (4.0 if len(y) and y[0] == 1 else -4.0 if len(y) else 0.0)
    pos, neg = int((y == 1).sum()), int((y == 0).sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, w = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * margins * margins).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, np.array([(g * margins).sum(), g.sum()]))
        a, b = a - float(step[0]), b - float(step[1])
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b


def scored(docs: DataFrame, margin, held_out: Column, cut: float) -> DataFrame:
    """doc_id, held_out, score and predicted for every row. margin: maps a block of texts to a score for each."""

    def run(batches):
        for ids, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(margin(texts), pa.float64())], names=["doc_id", "score"])

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    out = mapped(source, run, "doc_id long, score double")
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
