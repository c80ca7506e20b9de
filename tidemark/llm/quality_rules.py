"""Quality rules whose thresholds follow the data: mergeable quantile sketches for each language and source."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import durable, mapped, small_side, text_blocks

SYMBOLS = b"#*$%&|<>"
#: Words in a window of the repeat rule; the fixed base rules: fewest words, and most words in repeated windows in a hundred.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Relative error of a sketch's quantiles.
ALPHA = 0.01
#: Documents that a group's fence must rest on to weigh as much as its language's fence, and a language's as everyone's.
PRIOR = 200
#: A rate's fence lies SPREAD interquartile ranges above the third quartile on the sketch's logarithmic scale. Where the first quartile is 0, it
#: is this quantile of the rates above 0 (words with symbols are few and mostly all of a text's; repeats are common in small numbers).
SPREAD = 4.0
UPPER = {"symbol_rate": 0.5, "dup_rate": 0.99, "repeat_rate": 0.99, "word_size": 0.99}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of `window` (a power of two) words found twice or more in the text, the first included.

    Equal windows get equal numbers by doubling: a window of 2n words is the pair of two windows of n.
    """
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    width = 1
    while width < window:
        pairs = codes[:-width] * np.int64(n) + codes[width:]
        _, codes = np.unique(pairs, return_inverse=True)
        width *= 2
    twice = np.bincount(codes)[codes] > 1
    if not twice.any():
        return 0
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    return int((np.cumsum(step)[:n] > 0).sum())


def measures(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word)."""
    words = text.split()
    spaces = len(text) - sum(map(len, words))
    chars = len(text.decode()) - spaces
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measured(docs: DataFrame) -> DataFrame:
    """The measures of each whole text beside doc_id, lang and source."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = [r for _, texts in text_blocks([part]) for r in map(measures, texts)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *columns], names=names)

    names = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"], docs["source"])
    return mapped(source, run, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")


def rates() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_rate": F.floor(F.col("n_symbols") * 1000 / words),
        "dup_rate": F.floor(F.col("n_dup_lines") * 1000 / F.greatest("n_lines", F.lit(1))),
        "repeat_rate": F.floor(F.col("n_repeat_words") * 1000 / words),
        "word_size": F.floor(F.col("word_chars") * 1000 / words),
    }


def sketched(values: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """A quantile sketch of whole numbers from 0 up for each group: counts of logarithmic buckets (a DDSketch without its cap
    on buckets). Sketches merge by adding counts, so tasks pre-aggregate and groups roll up without another look at the rows."""
    gamma = (1 + ALPHA) / (1 - ALPHA)
    bucket = F.when(F.col(value) < 1, F.lit(0)).otherwise(F.lit(1) + F.ceil(F.log(F.col(value).cast("double")) / F.log(F.lit(gamma))))
    return values.withColumn("bucket", bucket).groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))


def value_of(bucket: Column) -> Column:
    """The rate that a bucket stands for."""
    gamma = (1 + ALPHA) / (1 - ALPHA)
    return F.when(bucket == 0, F.lit(0.0)).otherwise(2 * F.pow(F.lit(gamma), bucket - 1) / (gamma + 1))


def quantiles(sketch: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """The sketched quantiles of each group, and its number of values. A group's buckets are some hundreds."""
    own = Window.partitionBy(*by)
    ranked = sketch.withColumn("upto", F.sum("n").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(own))
    at = {name: F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), F.col("bucket"))) for name, q in points.items()}
    found = ranked.groupBy(*by).agg(F.max("all").alias("n"), *[b.alias(name) for name, b in at.items()])
    return found.select(*by, "n", *[value_of(F.col(name)).alias(name) for name in points])


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """A row for each group of `by`: the fence of every rate (f0, f1, ...; null where all rates are 0) and the number of values that it rests on (w0, w1, ...)."""
    names = list(UPPER)
    parts = quantiles(sketch, [*by, "rate"], {"low": 0.25, "high": 0.75})
    above = sketch.where("bucket > 0")
    upper = F.element_at(F.array(*[F.lit(UPPER[n]) for n in names]), F.col("rate") + 1)
    own = Window.partitionBy(*by, "rate")
    ranked = above.withColumn("upto", F.sum("n").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(own))
    tops = ranked.groupBy(*by, "rate").agg(F.max("all").alias("positive"), F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * upper), F.col("bucket"))).alias("top"))
    tops = tops.select(*[F.col(c).alias(f"t_{c}") for c in [*by, "rate"]], "positive", value_of(F.col("top")).alias("top"))
    same = F.lit(True)
    for c in [*by, "rate"]:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    joined = parts.join(tops, same, "left")
    fence = F.when(F.col("low") > 0, F.col("high") * F.pow(F.col("high") / F.col("low"), F.lit(SPREAD))).otherwise(F.col("top"))
    weight = F.when(F.col("low") > 0, F.col("n")).otherwise(F.coalesce("positive", F.lit(0)))
    rows = joined.select(*by, "rate", fence.alias("fence"), weight.cast("double").alias("weight"))
    wide = [F.max(F.when(F.col("rate") == i, F.col(c))).alias(f"{c[0]}{i}") for i in range(len(names)) for c in ("fence", "weight")]
    return rows.groupBy(*by).agg(*wide)


def shrunk(fence: Column, weight: Column, wider: Column) -> Column:
    """A group's fence, drawn towards the wider group's the more, the fewer values it rests on."""
    return F.coalesce((weight * fence + PRIOR * wider) / (weight + PRIOR), wider, fence)


def thresholds(rows: DataFrame) -> DataFrame:
    """t_lang, t_source and fences (an array, a fence for each rate or null) of each language and source, learnt from documents that pass the base rules:
    each group's own, drawn towards its language's in proportion to its rows, and that towards everyone's. Sketches merge by adding counts,
    so the languages' and everyone's come from the groups' without another look at the rows."""
    names = list(UPPER)
    listed = rows.where(~base_rules()).select("lang", "source", F.posexplode(F.array(*[rates()[n] for n in names])).alias("rate", "value"))
    finest = durable(sketched(listed, ["lang", "source", "rate"]))
    merged = lambda by: finest.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))
    top = fences(merged([]), []).first()  # one fence for each rate
    groups, langs = fences(finest, ["lang", "source"]), fences(merged(["lang"]), ["lang"])
    of_all = [F.lit(top[f"f{i}"] if top else None).cast("double") for i in range(len(names))]
    langs = langs.select(F.col("lang").alias("l_lang"), *[shrunk(F.col(f"f{i}"), F.col(f"w{i}"), of_all[i]).alias(f"l{i}") for i in range(len(names))])
    joined = groups.join(small_side(langs, 10_000), F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.array(*[shrunk(F.col(f"f{i}"), F.col(f"w{i}"), F.col(f"l{i}")) for i in range(len(names))]).alias("fences"))


def base_rules() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base measures and a verdict for each document: the fixed base rules, then fences learnt from its language and source.

    All measures are made in one pass over the texts and stored; the sketches and the joined filter read that small table.
    A document is dropped by a fence if its symbols, repeated lines, repeated windows or characters for each word lie above that of
    its group: there are no fixed cutoffs and no least size of a group (`thresholds`). Thresholds are joined back by a broadcast while
    the groups are proven to be few, else by a shuffled join, whose large groups Spark splits.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept. Null text: the empty
    text, which fails the base rules. Null lang or source: a group of its own. Null or repeated doc_ids: one result for each
    row. Groups without a document that passes have no fences. An empty table gives no rows; long texts are measured whole. Only doc_id, text, lang and source are read.
    """
    rows = durable(measured(docs))
    limits = durable(thresholds(rows))
    joined = rows.join(small_side(limits, 100_000), F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    base = base_rules()
    above = F.lit(False)
    for i, (_, rate) in enumerate(rates().items()):
        above = above | F.coalesce(rate > F.element_at("fences", i + 1), F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~above).alias("kept"))
