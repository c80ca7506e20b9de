"""Every operator and stage on nulls in any column, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import random
from collections import Counter

import public_tokenizers
import pytest

from tidemark.llm import bpe, exact_dedup, jaccard_join, packing, quality_classifier, quality_rules, queries, substring_dedup, token_counts, toxicity, url_filter

import corpus_pipeline

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
#: Columns that operators make or use themselves, in another type.
CLASH = ["DIGEST", "salt", "mark", "score", "held_out", "ids", "n_tokens", "window", "good", "keep_id", "n_words", "words", "content", "spans", "kept", "label", "start", "token", "x"]


def odd_rows():
    dice = random.Random(11)
    prose = lambda n: " ".join(f"w{dice.randrange(5000)}" for _ in range(n))
    long, common = prose(60_000), prose(80)
    rows = [(1, long, "en", "a", 1), (2, long.upper(), None, "a", 2), (3, None, "en", None, None), (4, "", None, None, 0), (None, prose(40), "en", "a", 3), (None, None, None, None, None)]
    rows += [(5, common, "fr", "b", 5)] * 3 + [(5, prose(60), "fr", "b", 5), (6, common + " tail", "fr", "b", 6), (7, " \t\n", "fr", "b", 7), (8, "word", "fr", "b", 8), (9, "x" * 200_000, "fr", "b", 9), (10, "é🙂\u0000 Ə" * 40, "de", "c", 10)]
    return rows + [(i, prose(120), "en", "a", i) for i in range(20, 40)]


ROWS = odd_rows()
TABLES = {"documents": SCHEMA, "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string"}
LABELS = [(i, i % 2, i % 3 % 2) for i in range(20, 40)] + [(20, 1, None), (21, None, 1), (None, 1, 1), (5, 0, 0), (5, 1, 1), (999, 1, 0)]
PAGES = [(1, "https://Example.COM/en/x", ""), (1, "https://Example.COM/en/x", None), (None, "http://a.net/fr/", ""), (2, None, ""), (3, "", ""), (4, "no scheme", ""), (5, "x://" + "a." * 5000 + "net/es/", "")]


@pytest.fixture(scope="module", params=["full", "empty"])
def folder(request, spark, tmp_path_factory):
    """The tables with odd rows, or with none, all with clashing columns."""
    at = str(tmp_path_factory.mktemp(request.param))
    for (name, schema), rows in zip(TABLES.items(), (ROWS, LABELS, PAGES), strict=True):
        more = [c for c in CLASH if f" {c.lower()} " not in schema.lower()]
        wide = [(*r, *["?"] * len(more)) for r in rows] if request.param == "full" else []
        spark.createDataFrame(wide, schema + "".join(f", {c} string" for c in more)).repartition(3).write.parquet(f"{at}/{name}.parquet")
    return request.param, at


@pytest.fixture
def docs(spark, folder):
    return spark.read.parquet(f"{folder[1]}/documents.parquet")


def ids(rows):
    return Counter(r.doc_id for r in rows)


EVERY = Counter(r[0] for r in ROWS)


@pytest.mark.parametrize("name", ["encode", "exact", "rules", "groups", "counts", "toxicity", "quality"])
def test_a_row_for_each_document(spark, folder, docs, name):
    labels = spark.read.parquet(f"{folder[1]}/labels.parquet")
    run = {
        "encode": lambda: bpe.encode_documents(docs, WORD, decode=True), "exact": lambda: exact_dedup.exact_dedup(docs), "rules": lambda: quality_rules.quality_rules(docs),
        "groups": lambda: jaccard_join.similar_groups(docs), "counts": lambda: token_counts.count_tokens(docs, PIECE),
        "toxicity": lambda: toxicity.toxicity_scores(docs, labels), "quality": lambda: quality_classifier.quality_scores(docs, labels),
    }
    rows = run[name]().collect()
    assert ids(rows) == (EVERY if folder[0] == "full" else Counter())
    if name in ("toxicity", "quality"):
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "exact" and rows:
        by = {(r.doc_id, r.text_sha256): r for r in rows}
        assert {r.keep_id for r in rows if r.doc_id in (1, 2)} == {2} and sum(r.kept for r in rows if r.doc_id == 5) == 2
        assert {r.group_size for r in by.values() if r.keep_id == 4} == {3}


def test_packing(folder, docs):
    rows = packing.packed_digests(docs, WORD).collect()
    if folder[0] == "empty":
        assert rows == []
        return
    tokens = Counter()
    for r in bpe.encode_documents(docs, WORD).collect():
        tokens[r.doc_id] += r.n_tokens + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == tokens


def test_removals_and_cuts(folder, docs):
    gone = substring_dedup.removals(docs).collect()
    left = substring_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert ids(left.collect()) == (EVERY if folder[0] == "full" else Counter())
    if folder[0] == "full":
        texts = {r.doc_id: r.text for r in left.collect()}
        assert texts[1] == ROWS[0][1] and len(texts[2] or "") < 100 and texts[3] is None and texts[4] == ""
        assert 2 in {r.doc_id for r in gone} and 1 not in {r.doc_id for r in gone}


def test_urls(spark, folder):
    rows = url_filter.url_verdicts(spark.read.parquet(f"{folder[1]}/pages.parquet"), url_filter.rule_table(spark)).collect()
    assert len(rows) == (len(PAGES) if folder[0] == "full" else 0)
    if rows:
        got = Counter((r.page_id, r.rule, r.verdict) for r in rows)
        assert got[(1, "example.com/en/", "block")] == 2 and got[(None, "net/fr/", "block")] == 1 and got[(5, "net/es/", "block")] == 1
        assert got[(2, None, "allow")] == got[(3, None, "allow")] == got[(4, None, "allow")] == 1


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, folder, docs, stage):
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, folder[1])
    assert out.columns == docs.columns
    kept, given = ids(out.collect()), EVERY if folder[0] == "full" else Counter()
    assert kept <= given
    if folder[0] == "full" and stage == "exact dedup":
        assert 1 not in kept and kept[2] == 1 and kept[5] == 2
    if folder[0] == "full" and stage == "n-gram Jaccard join":
        assert kept[1] == 1 and 2 not in kept and kept[4] == kept[3] == kept[7] == 1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, folder, name):
    rows = queries.QUERIES[name](spark, folder[1]).collect()
    assert rows == [] if folder[0] == "empty" else rows
