"""Token counts of a sentencepiece BPE vocabulary, with a proven shortcut for whole tokens."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe import gathered
from tidemark.llm.common import mapped, resident

#: Pre-tokens that are remembered between runs, and pre-tokens that the library encodes at once.
CACHE_TOKENS, AT_ONCE = 400_000, 20_000
MARK = "▁"  # stands for a space


class PieceCounter:
    """Counts of a text's tokens as the sum over its pre-tokens.

    What is proven from the vocabulary when it is loaded: (1) it leaves text as it is but for the leading space and the marks
    for spaces; (2) no token has a mark after another character, so no merge reaches back over the start of a run of
    spaces; (3) a line feed is in no token of several characters, so none reaches over it. Text is parted there, and the
    counts of the parts add up. (4) The whole tokens: vocabulary strings that the library encodes alone as one token, each
    of which was tried. They count one; only other parts go through the merges.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        norm, pieces = model.normalizer_spec, [p.piece for p in model.pieces if p.type == p.NORMAL]
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the vocabulary changes texts before it parts them")
        if any(p.type == p.USER_DEFINED for p in model.pieces) or any(MARK in p.lstrip(MARK) for p in pieces) or any("\n" in p and len(p) > 1 for p in pieces):
            raise ValueError("tokens of this vocabulary reach over spaces or line feeds")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        model.normalizer_spec.add_dummy_prefix = False  # parts are encoded as they stand; texts get the prefix below
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.whole = frozenset(p for p, ids in zip(pieces, self.library.encode(pieces, num_threads=1), strict=True) if len(ids) == 1)
        self.parts = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
        self.counts: dict[str, int] = {}

    def learn(self, parts: set[str]) -> None:
        if len(self.counts) > CACHE_TOKENS or not self.counts:
            self.counts = dict.fromkeys(self.whole, 1)
        rest = [p for p in parts if p not in self.counts]
        for at in range(0, len(rest), AT_ONCE):
            some = rest[at : at + AT_ONCE]
            self.counts.update(zip(some, map(len, self.library.encode(some, num_threads=1)), strict=True))

    def parted(self, text: str) -> list[str]:
        return self.parts.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def count(self, texts: list[str]) -> list[int]:
        new: set[str] = set()
        for text in texts:
            new.update(self.parted(text))
        self.learn(new)
        return [sum(map(self.counts.__getitem__, self.parted(text))) for text in texts]


def piece_counter(path: str) -> PieceCounter:
    """One vocabulary for each worker process."""
    return resident(("pieces", path), lambda: PieceCounter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of each whole text, and whether the tokens exceed `limit`.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit. Null text: the empty text, no tokens. Null or repeated doc_ids:
    one result for each row. Only doc_id and text are read. Tasks hold a run of texts and a bounded cache; no rows move.
    """

    def run(batches):
        counter = piece_counter(path)
        for keys, texts in gathered(batches, 8 << 20):
            n = counter.count([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(map(len, texts), pa.int64(), size=len(texts)), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return mapped(source, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", keeps=True)
