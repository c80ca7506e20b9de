"""Packing of documents' tokens into training windows of several lengths."""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import gathered, word_bpe
from tidemark.llm.common import mapped

#: Window lengths, shortest first, the id that ends a document, and the windows' tokens in a step group.
TIERS, END, GROUP_TOKENS = (256, 512, 1024, 2048), 1, 64 * 2048
COLUMNS = (
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int64()), ("step_group", pa.int64()),
)


class Tier:
    """Pieces of up to `window` tokens, found by length."""

    def __init__(self, window: int) -> None:
        self.window, self.pieces, self.tokens = window, [], 0

    def add(self, piece: tuple[int, int, int]) -> None:
        insort(self.pieces, piece)
        self.tokens += piece[0]

    def take(self, at: int) -> tuple[int, int, int]:
        piece = self.pieces.pop(at)
        self.tokens -= piece[0]
        return piece

    def fitting(self, room: int) -> int:
        """Where the longest piece of `room` tokens at most stands, else -1."""
        return bisect_right(self.pieces, (room, 1 << 62, 1 << 62)) - 1


def fill(pieces: list[tuple[int, int, int]], tiers=TIERS) -> tuple[list[tuple[int, list]], list]:
    """Full windows of pieces (length, document, start), and the pieces left over: fewer tokens than the longest window.

    Pieces are routed to the shortest tier that holds them. Tiers are packed from the longest: each window starts with its
    tier's longest piece; the gap takes the longest whole pieces that fit, of its own tier or shorter ones; what still is
    open is closed by cutting the shortest piece, whose other part is routed again.
    """
    longest = tiers[-1]
    by = [Tier(w) for w in tiers]
    windows = []

    def route(length: int, doc: int, start: int) -> None:
        by[next(i for i, w in enumerate(tiers) if length <= w)].add((length, doc, start))

    for length, doc, start in pieces:
        while length >= longest:
            windows.append((longest, [(longest, doc, start)]))
            length, start = length - longest, start + longest
        if length:
            route(length, doc, start)
    for i in reversed(range(len(tiers))):
        window, usable = tiers[i], by[: i + 1]
        while by[i].pieces and sum(t.tokens for t in usable) >= window:
            room, held = window, []
            while room:
                tier = next((t for t in reversed(usable) if t.fitting(room) >= 0), None)
                if tier:
                    piece = tier.take(tier.fitting(room))
                else:
                    length, doc, start = next(t for t in usable if t.pieces).take(0)
                    piece = (room, doc, start)
                    route(length - room, doc, start + room)
                held.append(piece)
                room -= piece[0]
            windows.append((window, held))
    return windows, [p for t in by for p in t.pieces]


def balanced(windows: list[tuple[int, list]], group_tokens: int = GROUP_TOKENS) -> list[int]:
    """A step group for each window: the longest first, each to the group with the fewest tokens, so that groups weigh alike."""
    total = sum(w for w, _ in windows)
    heap = [(0, g) for g in range(max(1, round(total / group_tokens)))]
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i][0]):
        held, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (held + windows[i][0], g))
    return out


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Every document's tokens (its text's, then id 1) in windows of 256, 512, 1024 and 2048 tokens.

    Each task packs its own documents, run by run as their tokens are made; the pieces that a run can't use up go into the
    next run's windows. Only a task's last window can be short, so padding is below one window for each task, and no rows
    move. Sequence ids hold the task's number in the upper bits, and stay the same if the task is run again.

    Returns a row for each piece: doc_id, start, length, ids (binary: little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id, offset, window, step_group (groups of about 64 long windows' tokens). Null text: the empty text, packed
    as its end id alone. Null or repeated doc_ids: each row is a document of its own. Only doc_id and text are read.
    """

    def run(batches):
        bpe = word_bpe(path)
        base = TaskContext.get().partitionId() << 33
        made = groups = 0
        end = END.to_bytes(4, "little")
        kept: dict[int, tuple] = {}  # documents with pieces that aren't placed yet: doc_id, ids
        waiting: list[tuple[int, int, int]] = []
        number = 0

        def rows(windows):
            nonlocal made, groups
            steps = balanced(windows)
            for (window, pieces), step in zip(windows, steps, strict=True):
                offset = 0
                for length, doc, start in pieces:
                    key, ids = kept[doc]
                    yield key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, base + made, offset, window, base + groups + step
                    offset += length
                made += 1
            groups += max(steps, default=-1) + 1

        def batches_of(found):
            out, size = [], 0
            for row in found:
                out.append(row)
                size += len(row[3])
                if size > 2 << 20:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

        for keys, texts in gathered(batches):
            for key, ids in zip(keys, bpe.encode(texts), strict=True):
                ids += end
                kept[number] = (key, ids)
                waiting.append((len(ids) // 4, number, 0))
                number += 1
            windows, waiting = fill(waiting)
            yield from batches_of(rows(windows))
            # a piece that waits keeps its document's ids from its start on
            kept = {p[1]: kept[p[1]] for p in waiting}
        if waiting:
            yield from batches_of(rows([(TIERS[-1], waiting)]))

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*found, strict=True), COLUMNS, strict=True)], names=[n for n, _ in COLUMNS])

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return mapped(source, run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window long, step_group long", keeps=True)


def packed_digests(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of `pack` with the CRC-32 of their ids in place of the ids; null texts, null or repeated doc_ids, empty tables and
    further columns are as there."""
    return pack(docs, path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_group")
