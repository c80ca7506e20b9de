"""Each stage of the pipeline, on what the stage before it kept, against a plain version."""

from collections import defaultdict

import pytest
from test_dedup import fold, jaccard_model, words
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import quality_classifier
from tidemark.llm.common import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage was given and gave."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        given, docs = docs, spark.read.parquet(f"{folder}/{name}")
        out[name] = (given, docs, given.collect(), docs.collect())
    return out


def test_stage_names_and_columns(spark, stages):
    assert list(stages) == ["quality classifier", "exact dedup", "n-gram Jaccard join", "substring dedup", "packing"]
    for given, docs, before, after in list(stages.values())[:-1]:
        assert docs.columns == given.columns == documents(spark, SF).columns
        assert 0 < len(after) <= len(before)


def test_quality(spark, stages):
    _, _, before, after = stages["quality classifier"]
    model = quality_classifier.train(documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r for r in before if model([(r.text or "").encode()])[0] >= 0.7]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in good)
    assert {r.doc_id: tuple(r) for r in after} == {r.doc_id: tuple(r) for r in good}


def test_exact(stages):
    _, _, before, after = stages["exact dedup"]
    best = defaultdict(int)
    for r in before:
        best[fold(r.text)] = max(best[fold(r.text)], r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())


def test_near(stages):
    _, _, before, after = stages["n-gram Jaccard join"]
    groups = jaccard_model([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (n, c) in groups.items() if i == c)


def test_passages(stages):
    _, _, before, after = stages["substring dedup"]
    given, left = ({r.doc_id: words(r.text) for r in rows} for rows in (before, after))
    assert set(given) == set(left)
    holders = defaultdict(set)
    for i, w in left.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    assert not [h for h in holders.values() if len(h) > 1]
    shared = defaultdict(set)
    for i, w in given.items():
        for k in range(len(w) - 23):
            shared[tuple(w[k : k + 24])].add(i)
    for i, w in given.items():  # what shares nothing with an earlier document is left alone
        if all(min(shared[tuple(w[k : k + 24])]) == i for k in range(len(w) - 23)):
            assert left[i] == w


def test_packing(stages):
    import public_tokenizers

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    _, _, before, after = stages["packing"]
    want = {r.doc_id: len(lib.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before}
    got = defaultdict(int)
    for r in after:
        got[r.doc_id] += r.length
        assert r.doc_tokens == want[r.doc_id]
    assert got == want


def test_run_is_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sum(r.length for r in corpus_pipeline.run(spark, SF).collect()) == sum(r.length for r in stages["packing"][3])
    assert {key(r)[0] for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id for r in stages["packing"][3]}
