"""Exact duplicates by skew-safe combining, in DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, durable, small_side

#: Rows that may be broadcast.
BROADCAST_ROWS = 100_000


def exact_dedup(docs: DataFrame, salts: int = 16, digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256)) -> DataFrame:
    """Which document stays of each set of texts that are identical after lower-casing A-Z.

    Rows are combined in three steps: each task groups its own rows by (digest, salt, text) before anything moves; those
    groups meet by (digest, salt), so that a text that a third of all rows share is spread over `salts` tasks; and the few
    winners of a digest, `salts` at most for each text, are combined by (digest, text). Grouping is by the text itself at
    every step, so texts whose digests collide stay apart. Answers go back to the documents by (digest, salt); where a
    digest has several texts (found by comparing them) that last join compares texts too.

    Returns doc_id, keep_id (largest doc_id of the equal texts), group_size, kept, text_sha256 (of the lower-cased text).

    Null text: the empty text. Null doc_id: never preferred to another; if all doc_ids of a group are null, keep_id is
    null. Rows that repeat a doc_id with the same text: all count in group_size, exactly one is kept. No rows: no rows.
    Only doc_id and text are read, so further columns cannot clash.
    """
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    base = docs.select("doc_id", text.alias("content")).select(
        "doc_id", "content", digest(F.col("content")).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")
    )
    salted = base.groupBy("digest", "salt", "content").agg(F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    same_digest, same_text = Window.partitionBy("digest"), Window.partitionBy("digest", "content")
    winners = (
        salted.withColumn("mixed", F.min("content").over(same_digest) != F.max("content").over(same_digest))
        .withColumn("keep_id", F.max("best").over(same_text))
        .withColumn("group_size", F.sum("n").over(same_text))
    )
    # The texts of colliding digests go along; all others are known by their digest from here on.
    winners = durable(winners.select("digest", "salt", "keep_id", "group_size", "mixed", F.when(F.col("mixed"), F.col("content")).alias("only_for")))
    rows = base.select("doc_id", "digest", "salt", F.sha2("content", 256).alias("text_sha256"), "content")
    answers = rows.drop("content").join(winners.where(~F.col("mixed")), ["digest", "salt"])
    if winners.where("mixed").limit(1).count():
        collided = winners.where("mixed").withColumn("content", F.col("only_for"))
        answers = answers.unionByName(rows.join(collided, ["digest", "salt", "content"]).drop("content"))
    turn = F.row_number().over(Window.partitionBy("digest", "salt", "text_sha256", "doc_id").orderBy("group_size"))
    return answers.withColumn("turn", turn).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of docs, all columns, that `exact_dedup` keeps: one of each set of equal texts, with the largest doc_id.

    Rows are told apart by doc_id and digest of the text; of rows that repeat both, one stays. Texts don't move again as long
    as the dropped rows are proven few enough for a broadcast; beyond that the rows are shuffled.
    """
    answers = durable(exact_dedup(docs, salts))
    by = answers.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    gone, repeated = durable(by.where("not stays").drop("stays", "n")), durable(by.where("stays and n > 1").drop("stays", "n"))
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc_id, text = (f"c{[n.lower() for n in names].index(c)}" for c in ("doc_id", "text"))
    keyed = plain.withColumn("digest", F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256))
    out = _others(keyed, gone, doc_id)
    if repeated.limit(1).count():
        both = keyed.join(repeated, _same(keyed, repeated, doc_id), "left_semi")
        once = both.withColumn("turn", F.row_number().over(Window.partitionBy(doc_id, "digest").orderBy("digest"))).where("turn = 1").drop("turn")
        out = _others(out, repeated, doc_id).unionByName(once)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def _same(keyed: DataFrame, rows: DataFrame, doc_id: str) -> Column:
    return keyed[doc_id].eqNullSafe(rows["doc_id"]) & (keyed["digest"] == rows["text_sha256"])


def _others(keyed: DataFrame, rows: DataFrame, doc_id: str) -> DataFrame:
    side = small_side(rows, BROADCAST_ROWS)
    return keyed.join(side, _same(keyed, side, doc_id), "left_anti")
