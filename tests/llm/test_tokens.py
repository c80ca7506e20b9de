import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, queries, token_counts

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"
TEXTS = [
    "", " ", "\n\t ", "The quick brown fox", "it's we'll I'D they've", "ÇA va? Été İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|>", "x\x1cy\x85z a​b c d",
    "é ́a n̈ ﬁ ２３ ½ Ⅷ", "日本語 テスト 😀👩‍👩‍👧", "a" * 3000, "#" * 300, "aaa bbb " * 50, "<s> </s> <unk> <0x0A> ▁▁ a", " lead", "trail ", "a\n\nb\r\n", "Ĳ ǅ ſ ẞ Ə ı ŀ·l À×÷ª²",
]
anything = st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=80)


def library():
    return Tokenizer.from_file(WORD)


def test_word_bpe_equals_the_library():
    model, lib = bpe.WordBpe(WORD), library()
    ids = [np.frombuffer(x, np.uint32).tolist() for x in model.encode([t.encode() for t in TEXTS])]
    assert ids == [e.ids for e in lib.encode_batch(TEXTS, add_special_tokens=False)]
    for x in ids:
        assert model.decode(np.array(x, np.uint32).tobytes()).decode() == lib.decode(x, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(anything, min_size=1, max_size=5))
def test_word_bpe_of_any_text(texts):
    model, lib = bpe.word_bpe(WORD), library()
    ids = [np.frombuffer(x, np.uint32).tolist() for x in model.encode([t.encode() for t in texts])]
    assert ids == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_word_bpe_of_latin_letters_beside_signs():
    """Every code point from U+00C0 to U+024F beside digits, signs and letters, and random chunks of them."""
    model, lib = bpe.word_bpe(WORD), library()
    latin = [chr(c) for c in range(0xC0, 0x250)]
    texts = [" ".join((f"{c}x1", f"x{c},", f"{c}.a", f"1{c}", f"{c}li-2", f"-{c}", f"{c}'s", c + c + "!")) for c in latin]
    rng = random.Random(3)
    texts += ["".join(rng.choice(latin if rng.random() < 0.5 else "abzAZ019.,-'&") for _ in range(rng.randrange(2, 9))) for _ in range(10_000)]
    ids = [np.frombuffer(x, np.uint32).tolist() for x in model.encode([t.encode() for t in texts])]
    assert ids == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_long_and_short_lists_merge_alike(monkeypatch):
    rng = random.Random(1)
    words = list({"".join(rng.choice("aabcdeinorst") for _ in range(rng.randrange(1, 14))).encode() for _ in range(3000)})
    model = bpe.WordBpe(WORD)
    monkeypatch.setattr(bpe, "LONG_LIST", 2)
    one = model.merge(words)
    monkeypatch.setattr(bpe, "LONG_LIST", 10**9)
    assert one == model.merge(words)


def test_piece_counts_equal_the_library():
    counter, lib = token_counts.PieceCounter(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert counter.count(TEXTS) == [len(x) for x in lib.encode(TEXTS, num_threads=1)]
    assert len(counter.whole) > 30_000


@settings(max_examples=300, deadline=None)
@given(anything)
def test_piece_counts_of_any_text(text):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert token_counts.piece_counter(PIECE).count([text]) == [len(lib.encode(text, num_threads=1))]


ROWS = [*enumerate(TEXTS), (98, None), (None, "no id"), (3, "again"), (3, "again")]


def test_queries_of_tokens(spark, tmp_path):
    spark.createDataFrame(ROWS, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    lib, pieces = library(), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def coded(t):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())

    got = sorted((tuple(r) for r in queries.op2_bpe(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((i, *coded(t)) for i, t in ROWS), key=str)
    got = sorted((tuple(r) for r in queries.op7_token_counts(spark, str(tmp_path)).collect()), key=str)
    want = [(i, len((t or "").encode()), n, n > 4096) for i, t in ROWS for n in [len(pieces.encode(t or "", num_threads=1))]]
    assert got == sorted(want, key=str)


def packed(spark, tmp_path, rows, parts):
    spark.createDataFrame(rows, DOCS).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op5_packing(spark, str(tmp_path)).collect()


def test_packing_is_whole_and_tight(spark, tmp_path):
    rng, lib = random.Random(2), library()
    rows = [(i, " ".join(rng.choice(["ab", "house", "Zürich", "12,", "qzx"]) for _ in range(rng.choice([0, 3, 40, 300, 700, 1500, 5000])))) for i in range(150)] + [(200, None)]
    got = packed(spark, tmp_path, rows, 2)
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length, r.window, r.step_group))
    for i, own in pieces.items():
        at = 0
        for start, n in sorted(own):
            assert start == at
            at += n
        assert at == len(ids[i])
    assert set(pieces) == set(ids)
    short = 0
    for own in windows.values():
        at = 0
        for offset, n, _, _ in sorted(own):
            assert offset == at
            at += n
        assert at <= own[0][2] <= 2048 and len({w[2:] for w in own}) == 1
        short += not math.log2(at).is_integer()
    assert short <= 2  # one for each task
    assert {own[0][2] for own in windows.values()} <= {256, 512, 1024, 2048}


def test_step_groups_weigh_alike():
    windows = [(w, []) for w in [2048] * 30 + [1024] * 33 + [512] * 11 + [256] * 50]
    weights = defaultdict(int)
    for (w, _), g in zip(windows, packing.balanced(windows, 16 * 2048), strict=True):
        weights[g] += w
    assert max(weights.values()) - min(weights.values()) <= 2048


def test_packing_of_nothing_and_repeated_ids(spark, tmp_path):
    assert packed(spark, tmp_path / "a", [], 1) == []
    got = packed(spark, tmp_path / "b", [(1, "a"), (1, "a"), (None, "b c")], 1)
    assert sorted(str((r.doc_id, r.doc_tokens)) for r in got) == ["(1, 2)", "(1, 2)", "(None, 3)"]
