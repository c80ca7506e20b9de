"""The training-data pipeline: good documents, once each, without repeated passages, packed into windows.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, jaccard_join, packing, quality_classifier, substring_dedup
from tidemark.llm.common import Scratch, documents

#: Words of a shingle and the least similarity (percent) of near duplicates in the pipeline.
SHINGLE, PERCENT = 5, 80


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels, as in its own query. A null text is judged as the
    empty one; rows of one doc_id are judged each for itself; an empty table stays empty."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (but for the case of A-Z) the one with the largest doc_id; null and empty texts are equal, a null
    doc_id is never preferred, and of rows that repeat doc_id and text one stays."""
    return exact_dedup.keep_first(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id; documents without words, null texts among them, all stay."""
    return jaccard_join.keep_one(docs, SHINGLE, PERCENT)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one (by doc_id) has too; null texts and null doc_ids stay as they are."""
    return substring_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a training window; a null text is packed as its end id alone, every row for itself."""
    return packing.packed_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("n-gram Jaccard join", dissimilar),
    ("substring dedup", unrepeated),
    ("packing", packed),
]

#: The classifier and the tokens can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each on the stored result of the one before."""
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
