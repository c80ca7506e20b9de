"""Byte-pair encoding and decoding with an index of pair occurrences, and token streams for packing.

The vocabulary files are those of the public `tokenizers` format: BPE with an end-of-word suffix, a normaliser, a
pre-tokeniser and special tokens. Nothing is trained here.
"""

from __future__ import annotations

import gc
import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import blocks, mapped, resident

#: Words of ASCII, after lower-casing, as the vocabulary's pre-tokeniser parts them.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def latin_letters(first: int = 0xC0, last: int = 0x24F) -> str:
    """The letters of these code points whose lower case is a single letter of them too, so that lower-casing stays in the class."""
    return "".join(c for c in map(chr, range(first, last + 1)) if c.isalpha() and len(low := c.lower()) == 1 and first <= ord(low) <= last and low.isalpha())


#: Chunks of these characters alone are unchanged by the normaliser but for lower case; all but ASCII's are letters.
LETTERS = latin_letters()
LATIN = re.compile(f"[\x21-\x7e{LETTERS}]+")
LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^\sa-z0-9{LETTERS}]+", re.ASCII)
#: Chunks that are remembered between the blocks of a worker process, and chunks that go through the index at once.
CACHE_CHUNKS, INDEX_CHUNKS = 200_000, 30_000
#: Positions of a pair from which on they are merged by array operations.
LONG_LIST = 48
#: Bytes of text whose distinct chunks are gathered at once.
GATHER_BYTES = 8 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable Latin-1, else the next unused one from U+0100."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class WordBpe:
    """A vocabulary file with the tables that encoding and decoding need."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        if len({m[2] for m in self.merges}) != len(self.merges):
            raise ValueError("two merges make the same token: merging rank by rank over many words could differ from word by word")
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(self.merges)}
        chars = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.inner_ids = np.array([vocab[c] for c in chars], np.int64)
        self.last_ids = np.array([vocab[c + suffix] for c in chars], np.int64)
        keys = np.array([a << 32 | b for a, b, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) or r"(?!)")
        strings = {i: s for s, i in (vocab | self.special).items()}
        self.strings = [strings.get(i, "").encode() for i in range(max(strings) + 1)]
        # the library's normaliser and pre-tokeniser, without its copy of the vocabulary
        self.library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}))
        self.cache: dict[bytes, bytes] = {}

    # -- before the merges

    def words(self, chunk: bytes) -> list[int | bytes]:
        """The words (as bytes) and special tokens (as ids) of a chunk of text without ASCII white space."""
        if chunk.isalpha():  # letters of ASCII alone
            return [chunk.lower()]
        if chunk[:-1].isalpha() and chunk[-1] < 128:  # and one other sign
            return [chunk[:-1].lower(), chunk[-1:]]
        text = chunk.decode()
        if not self.special_at.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.special_at.finditer(text):
            out += [*self._plain(text[at : found.start()]), self.special[found[0]]]
            at = found.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[bytes]:
        if text.isascii():
            return [w.encode() for w in ASCII_WORDS.findall(text.lower())]
        if LATIN.fullmatch(text):
            if text.isalpha():
                return [text.lower().encode()]
            return [w.encode() for w in LATIN_WORDS.findall(text.lower())]
        parted = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in piece) for piece, _ in parted]

    # -- the merges

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where it has none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers. All words' symbols stand in one row; an index maps each
        pair that has a rank to all its positions.

        Ranks are applied in ascending order over every position at once, left to right; each merge adds the two pairs that it
        makes to the index. A merge's token is made by no other merge, so pairs that hold it have higher ranks: no rank comes
        back once it is done, and the order within each word is that of merging the word alone. Long lists of positions are
        merged by array operations, short ones one by one.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = int(lengths.sum()) + len(words)
        stops = np.cumsum(lengths + 1) - 1  # a stop after each word
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        row = self.inner_ids[data]
        row[stops - 1] = self.last_ids[data[stops - 1]]
        row[stops] = -1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        first = self.ranks(row[:-1], row[1:])
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        found, begin = np.unique(first[at], return_index=True)
        where = {int(r): part.tolist() for r, part in zip(found, np.split(at, begin[1:]), strict=True)} if len(at) else {}
        active = list(where)
        heapq.heapify(active)
        rank, merges = self.rank, self.merges
        symbols, nexts, lasts = memoryview(row), memoryview(after), memoryview(before)

        def add(ranks: np.ndarray, positions: np.ndarray) -> None:
            ok = ranks >= 0
            order = np.argsort(ranks[ok], kind="stable")
            ranks, positions = ranks[ok][order], positions[ok][order]
            if not len(ranks):
                return
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for r, part in zip(ranks[cuts].tolist(), np.split(positions, cuts[1:]), strict=True):
                if r not in where:
                    heapq.heappush(active, r)
                    where[r] = []
                where[r] += part.tolist()

        while active:
            r = heapq.heappop(active)
            left, right, made = merges[r]
            positions = where.pop(r)
            if len(positions) >= LONG_LIST and left != right:
                i = np.sort(np.array(positions))
                i = i[(row[i] == left) & (np.diff(i, prepend=-1) > 0)]
                i = i[row[after[i]] == right]
                j = after[i]
                k = after[j]
                row[i], row[j] = made, -2
                after[i] = k
                before[k[k < n]] = i[k < n]
                h = before[i]
                sides = np.concatenate([h, i])
                to = np.concatenate([i, k])
                ok = (sides >= 0) & (to < n)
                sides, to = sides[ok], to[ok]
                if len(sides):
                    add(self.ranks(row[sides], row[to]), sides)
                continue
            for i in sorted(positions):
                j = nexts[i]
                if symbols[i] != left or symbols[j] != right:
                    continue
                symbols[i], symbols[j] = made, -2
                k = nexts[i] = nexts[j]
                lasts[k] = i
                if (q := rank.get((made, symbols[k]))) is not None:
                    if q not in where:
                        heapq.heappush(active, q)
                        where[q] = []
                    where[q].append(i)
                h = lasts[i]
                if h >= 0 and (q := rank.get((symbols[h], made))) is not None:
                    if q not in where:
                        heapq.heappush(active, q)
                        where[q] = []
                    where[q].append(h)
        live = row >= 0
        ids = row[live].astype("<u4").tobytes()
        ends = (4 * np.cumsum(live)[stops]).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    # -- texts

    def learn(self, chunks: set[bytes]) -> None:
        """Put the ids of chunks that aren't known yet into the cache, by the pair index. A word that several chunks hold, with other
        signs around it, is merged once."""
        ids: dict[bytes, bytes] = {}
        for part in self._unknown(chunks):
            parted = [self.words(c) for c in part]
            new = list({w for words in parted for w in words if type(w) is bytes}.difference(ids))
            if new:
                ids.update(zip(new, self.merge(new), strict=True))
            for chunk, words in zip(part, parted, strict=True):
                if len(words) == 1 and type(words[0]) is bytes:
                    self.cache[chunk] = ids[words[0]]
                else:
                    self.cache[chunk] = b"".join([ids[w] if type(w) is bytes else w.to_bytes(4, "little") for w in words])

    def _unknown(self, chunks: set[bytes]):
        if len(self.cache) > CACHE_CHUNKS:  # what these texts hold too is frequent enough to stay
            self.cache = {c: self.cache[c] for c in chunks if c in self.cache}
        new = [c for c in chunks if c not in self.cache]
        return [new[i : i + INDEX_CHUNKS] for i in range(0, len(new), INDEX_CHUNKS)]

    def encode(self, texts: list[bytes]):
        """The ids of each text as little-endian unsigned 32-bit integers, one text after the other.

        White space of ASCII parts chunks whose ids don't depend on each other: the normaliser turns every run of white
        space into one space, which the pre-tokeniser drops; no canonical composition reaches across a space; and special
        tokens hold no white space.
        """
        seen: set[bytes] = set()
        for text in texts:
            seen.update(text.split())
        gc.disable()  # what follows makes many small objects and no cycles
        try:
            self.learn(seen)
        finally:
            gc.enable()
        known = self.cache.__getitem__
        for text in texts:
            yield b"".join(map(known, text.split()))

    def decode(self, ids: bytes) -> bytes:
        """The text of ids as the library's decode without a decoder gives it: the tokens' strings with a space between."""
        strings = self.strings
        return b" ".join([strings[i] for i in np.frombuffer(ids, np.uint32).tolist()])


def word_bpe(path: str) -> WordBpe:
    """One vocabulary for each worker process."""
    return resident(("words", path), lambda: WordBpe(path))


def gathered(batches, limit: int = GATHER_BYTES):
    """(ids, texts as bytes) in runs of about `limit` bytes of text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for mine, own in blocks(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                ids += mine
                texts += own
                size += sum(map(len, own))
                if size >= limit:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode_documents(docs: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """Token ids of each whole text, and with `decode` what they decode to.

    Each task gathers the distinct chunks of its texts, encodes the new ones through one pair index, and puts the texts
    together from them; no rows move between tasks and memory is bounded by the gathered run, the index and the cache.

    Returns doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers) and, if asked for, decoded. Null text:
    the empty text, no ids. Null or repeated doc_ids: one result for each row. Only doc_id and text are read.
    """

    def run(batches):
        bpe = word_bpe(path)
        for keys, texts in gathered(batches):
            out = []
            size = 0
            encoded = bpe.encode(texts)
            for key, ids in zip(keys, encoded, strict=True):
                out.append((key, len(ids) // 4, ids, *([bpe.decode(ids).decode()] if decode else [])))
                size += len(ids)
                if size > 2 << 20:
                    yield batch_of(out)
                    out, size = [], 0
            if out:
                yield batch_of(out)

    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), *([("decoded", pa.string())] if decode else [])]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return mapped(source, run, "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode, keeps=True)
