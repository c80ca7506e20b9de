"""Passages that repeat across documents, by MinHash bands over paragraphs that their own words place."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import MASK, Scratch, blocks, durable, mapped, mix, shingle_hashes, signed, small_side, text_blocks, whole_groups, word_hashes
from tidemark.operators.components import connected_components

#: Words of a window, and starts of which one is chosen: every passage of LENGTH + CHOICE - 1 = 50 words holds a window.
LENGTH, CHOICE = 24, 27
#: Chunks run from one anchor to the first that stands SPAN words on; an anchor has the smallest shingle hash of the REACH on either side.
SPAN, REACH = 48, 16
#: The longest line, in words, that is a paragraph; longer ones have chunks only.
LONGEST_LINE = 256
#: Words of a shingle, the least similarity in percent, and the recall that the bands are tuned for.
SHINGLE, PERCENT, RECALL = 5, 80, 0.99
#: Words on either side of a passage that are compared: fewer than CHOICE can lie beyond a passage's last window.
CONTEXT = 32
#: Rows of four numbers that may be broadcast: some tens of megabytes.
BROADCAST_ROWS = 1_000_000
#: Contents of a band that are held against each other at once; more are dealt in blocks of as many.
BLOCK = 16_384
#: Contents of a group up to which all of its pairs are made at once, and members of pairs that are compared at once.
SMALL_GROUP, COMPARED = 16, 4_000_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_TOP = np.uint64(MASK)
_PLACE = np.uint64((1 << 31) - 1)
_BASE = 0x9FB21C651E98DF25


def tune_bands(similarity: float, recall: float, most_bands: int = 3) -> tuple[int, int]:
    """Bands and rows in a band: the most rows (fewest chance meetings) with which `most_bands` bands at most still find a pair
    of the similarity with the recall; a single row in a band if none does."""
    best = (most_bands, 1)
    for rows in range(1, 9):
        for bands in range(1, most_bands + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                best = (bands, rows)
                break
    return best


BANDS, ROWS = tune_bands(PERCENT / 100, RECALL)
KEYS = [f"b{i}" for i in range(BANDS)]


# -- paragraphs of a block of texts


@lru_cache(maxsize=2)
def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number modulo 2^64, and of its inverse."""
    make = lambda x: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]))
    return make(_BASE), make(pow(_BASE, -1, 1 << 64))


class Words:
    """The word and shingle hashes of a block of texts, one text after the other."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        self.hashes, self.offsets, self.begins = word_hashes(texts, places=True)
        n = len(self.hashes)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.offsets))
        self.room = self.offsets[1:][self.text] - np.arange(n)  # words from here to the end of the text
        self.shingles = np.zeros(n, np.uint64)
        if n >= SHINGLE:
            self.shingles[: n - SHINGLE + 1] = shingle_hashes(self.hashes, SHINGLE)

    def contents(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A hash of the words of each range: a difference of prefix sums, so ranges of any length cost the same."""
        n = len(self.hashes)
        power, inverse = _base_powers(1 << max(10, n.bit_length()))
        upto = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * power[:n], out=upto[1:])
        return mix((upto[first + length] - upto[first]) * inverse[first] + mix(length.astype(np.uint64)))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours."""
    have = 1
    while have < width and len(x):
        step = min(have, width - have)
        x, have = np.minimum(x[:-step], x[step:]), have + step
    return x


def windows(w: Words) -> np.ndarray:
    """Where windows of LENGTH words start: at the smallest shingle hash of any CHOICE neighbouring starts. Which start that is depends on the
    words of the passage alone, so copies of a passage are parted alike wherever they stand. A text with fewer starts has one window."""
    n = len(w.hashes)
    key = np.where(w.room >= LENGTH, (mix(w.shingles) & ~_PLACE) | np.arange(n, dtype=np.uint64), _TOP)
    least = sliding_minimum(key, CHOICE)
    found = least[w.room[: len(least)] >= LENGTH + CHOICE - 1]
    starts = np.diff(w.offsets) - LENGTH + 1
    short = np.flatnonzero((starts > 0) & (starts < CHOICE))
    if len(short):
        at = w.offsets[:-1][short]
        found = np.append(found, np.minimum.reduceat(key, np.stack([at, at + starts[short]], 1).ravel())[::2])
    return np.unique(found & _PLACE).astype(np.int64)


def chunks(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the larger paragraphs that the words place: from each anchor to the end of a later one's shingle."""
    n = len(w.hashes)
    if n < SHINGLE:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(n) + (w.text + 1) * REACH  # texts stand apart
    order = np.full(int(place[-1]) + REACH + 1, _TOP)
    own = mix(w.shingles ^ np.uint64(_BASE))
    whole = w.room >= SHINGLE
    order[place[whole]] = own[whole]
    least = sliding_minimum(order, 2 * REACH + 1)
    at = np.flatnonzero(whole & (own == least[place - REACH]))
    apart_by_text = at + (w.text[at] << 32)
    to = np.searchsorted(apart_by_text, apart_by_text + SPAN)
    ok = to < len(at)
    ok[ok] = w.text[at[to[ok]]] == w.text[at[ok]]
    return at[ok], at[to[ok]] - at[ok] + SHINGLE


def lines(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the lines of LENGTH to LONGEST_LINE words."""
    ends = np.flatnonzero(np.frombuffer(b"\n".join(w.texts), np.uint8) == 10)
    line = np.searchsorted(ends, w.begins)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    length = np.diff(np.append(first, len(line)))
    ok = (length >= LENGTH) & (length <= LONGEST_LINE)
    return first[ok], length[ok]


def apart(at: np.ndarray, content: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which paragraphs stay when of a run of overlapping equal ones every length-th word starts one."""
    again = np.zeros(len(at), bool)
    again[1:] = (content[1:] == content[:-1]) & (np.diff(at) < length[1:])
    run = np.maximum.accumulate(np.where(again, 0, at)) if len(at) else at
    return ~again | ((at - run) % np.maximum(length, 1) == 0)


def range_minimum(x: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The minimum of x over each range, from tables of the minima of 1, 2, 4, ... neighbours."""
    level = np.frexp(count.astype(float))[1] - 1
    out, width = np.zeros(len(first), x.dtype), 1
    for k in range(int(level.max(initial=-1)) + 1):
        own = level == k
        a = first[own]
        out[own] = np.minimum(x[a], x[a + count[own] - width])
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return out


def band_keys(shingles: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """A key for each band and range of shingles, from the smallest of ROWS permuted shingle hashes."""
    out = []
    for band in range(BANDS):
        key = np.full(len(first), band + 1, np.uint64)
        for row in range(ROWS):
            turn = mix(np.array([1 + band * ROWS + row], np.uint64))[0] | np.uint64(1)
            x = shingles * turn
            key = mix(key + range_minimum(x ^ (x >> np.uint64(29)), first, count))
        out.append(key)
    return out


@dataclass
class Paragraphs:
    """text: the number of each paragraph's text; start: its first word there; the last len(keys[0]) ones have band keys."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    content: np.ndarray
    keys: list[np.ndarray]


def paragraphs(texts: list[bytes]) -> Paragraphs:
    """All paragraphs of a block of texts: windows, of which only equal ones are linked, then lines and chunks, which have band keys."""
    w = Words(texts)

    def placed(at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        content = w.contents(at, length)
        keep = apart(at + (w.text[at] << 32), content, length)
        return at[keep], length[keep], content[keep]

    at = windows(w) if len(w.hashes) else np.zeros(0, np.int64)
    parts = [placed(at, np.full(len(at), LENGTH)), placed(*lines(w)), placed(*chunks(w))]
    near_at, near_length = (np.concatenate([p[i] for p in parts[1:]]) for i in (0, 1))
    at, length, content = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return Paragraphs(w.text[at], at - w.offsets[w.text[at]], length, content, band_keys(w.shingles, near_at, near_length - SHINGLE + 1))


def text_mark(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")


def paragraph_table(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text), start, length, content and band keys (null for windows) of all paragraphs."""

    def run(batches):
        for ids, texts in text_blocks(batches):
            p = paragraphs(texts)
            marks = np.array([text_mark(t) for t in texts], np.int64)
            n = len(p.text)
            bare = np.arange(n) < n - len(p.keys[0])
            keys = [pa.array(signed(np.append(np.zeros(n - len(k), np.uint64), k)), mask=bare) for k in p.keys]
            columns = [pa.array(np.array(ids, np.int64)[p.text]), pa.array(marks[p.text]), pa.array(p.start.astype(np.int32)), pa.array(p.length.astype(np.int32)), pa.array(signed(p.content)), *keys]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "start", "length", "content", *KEYS])

    return mapped(_plain(docs), run, "doc_id long, mark long, start int, length int, content long, " + ", ".join(f"{k} long" for k in KEYS))


# -- texts of some documents again


def asked_texts(docs: DataFrame, asked: DataFrame, fields: list[str], answer, schema: str) -> DataFrame:
    """What `answer` makes of the texts of which `asked` (doc_id, mark and whole numbers, `fields`) has rows. It gets the words of a block of
    texts, the number of each row's text, and the rows as arrays. Texts move once; a doc_id with many texts is split by Spark's skew join."""
    one = asked.groupBy("doc_id", "mark").agg(F.collect_list(F.struct(*[F.col(f).cast("long").alias(f) for f in fields])).alias("asked"))
    both = _plain(docs).join(one, "doc_id").select("doc_id", "text", "mark", "asked")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                marks, lists = part.column(2).to_pylist(), part.column(3)
                counts = lists.value_lengths().to_numpy()
                ends = np.cumsum(counts)
                flat = lists.flatten()
                values = [flat.field(i).to_numpy() for i in range(len(fields))]
                own = [i for i, t in enumerate(texts) if t is not None and text_mark(t) == marks[i]]
                for rows, some in blocks(own, [texts[i] for i in own]):
                    n = counts[rows].astype(np.int64)
                    taken, text = ranges(ends[rows] - n, n), np.repeat(np.arange(len(rows)), n)
                    yield answer(Words(some), text, *[v[taken] for v in values])

    return mapped(both, run, schema)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indices of ranges, one after the other."""
    return np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)


def members_of(docs: DataFrame, places: DataFrame) -> DataFrame:
    """content and members (its distinct shingle hashes as sorted unsigned 32-bit integers) of places (doc_id, mark, start, length, content)."""

    def answer(w, text, start, length, content):
        first, count = w.offsets[text] + start, length - SHINGLE + 1
        owner = np.repeat(np.arange(len(first), dtype=np.uint64), count)
        pairs = np.unique(owner << np.uint64(32) | w.shingles[ranges(first, count)] >> np.uint64(32))
        n = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(first))
        offsets = np.append(0, 4 * np.cumsum(n)).astype(np.int32)
        data = (pairs & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
        members = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([pa.array(content, pa.int64()), members], names=["content", "members"])

    return asked_texts(docs, places, ["start", "length", "content"], answer, "content long, members binary")


# -- pairs that meet in a band


class Held:
    """Contents with their members, as arrays: rows of a table sorted by group."""

    def __init__(self, table: pa.Table) -> None:
        column = lambda name: table.column(name).to_numpy()
        self.group, self.content, self.low = column("group"), column("content"), column("low")
        self.left, self.component = column("left_side"), column("component")
        members = table.column("members").to_pylist()
        self.n = np.array([len(m) // 4 for m in members], np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.members = np.frombuffer(b"".join(members), "<u4")
        bit = np.uint64(1) << (self.members >> np.uint32(26)).astype(np.uint64)
        more = np.uint64(1) << (self.members >> np.uint32(20) & np.uint32(63)).astype(np.uint64)
        self.bits = [np.bitwise_or.reduceat(b, self.first) for b in (bit, more)]

    def possible(self, i, j) -> np.ndarray:
        """Whether pairs can have the similarity: sets of m and n members that have it differ in (m + n) / 9 of them at most, and so do their
        bitmaps. Contents with the same smallest doc_id are no pair: neither could make the other go."""
        most = (100 - PERCENT) * (self.n[i] + self.n[j])
        ok = (self.low[i] != self.low[j]) & ((100 + PERCENT) * abs(self.n[i] - self.n[j]) <= most)
        for bits in self.bits:
            ok = ok & ((100 + PERCENT) * np.bitwise_count(bits[i] ^ bits[j]).astype(np.int64) <= most)
        return ok

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs have the similarity, by the exact size of their sets' intersection."""
        out = np.zeros(len(i), bool)
        size = self.n[i] + self.n[j]
        cut = np.flatnonzero(np.diff((np.cumsum(size) - 1) // COMPARED, prepend=0, append=-1)) if len(i) else []
        for a, b in zip([0, *cut], cut, strict=False):
            x, y, total = i[a:b], j[a:b], size[a:b]
            if not len(x):
                continue
            owner = np.repeat(np.arange(len(x), dtype=np.uint64), 2)
            sides = np.stack([x, y], 1).ravel()
            keys = np.repeat(owner, self.n[sides]) << np.uint64(32) | self.members[ranges(self.first[sides], self.n[sides])].astype(np.uint64)
            keys.sort()
            shared = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> np.uint64(32)).astype(np.int64), minlength=len(x))
            out[a:b] = (100 + PERCENT) * shared >= PERCENT * total
        return out


def links_within(held: Held, sided: bool = False):
    """Pairs of contents that have the similarity, enough of them that every such pair of a group stands in one piece. Pairs of small groups are all
    compared at once; in larger ones each content is held against those that aren't joined to it yet, so at most one link for each content goes out.

    sided: each content of a group's left side against those of its other side, in other components so far."""
    begin = np.flatnonzero(np.diff(held.group, prepend=held.group[0] - 1))
    size = np.diff(np.append(begin, len(held.group)))
    a, b = [], []
    small = np.repeat((size <= SMALL_GROUP) & (not sided), size)
    for step in range(1, SMALL_GROUP):
        i = np.flatnonzero(small[:-step] & small[step:] & (held.group[:-step] == held.group[step:])) if len(small) > step else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[held.possible(i, i + step)]
        ok = held.similar(i, i + step)
        a.append(held.content[i[ok]])
        b.append(held.content[i[ok] + step])
    for first, n in zip(begin[~small[begin]].tolist(), size[~small[begin]].tolist(), strict=True):
        rows = np.arange(first, first + n)
        joined = held.component[rows].copy() if sided else np.arange(n)
        for k in np.flatnonzero(held.left[rows]).tolist() if sided else range(n - 1):
            other = np.flatnonzero(~held.left[rows] & (joined != joined[k])) if sided else k + 1 + np.flatnonzero(joined[k + 1 :] != joined[k])
            other = other[held.possible(first + k, first + other)]
            other = other[held.similar(np.full(len(other), first + k), first + other)]
            # one link for each component that the content meets
            _, at = np.unique(joined[other], return_index=True)
            for o in other[at]:
                a.append(held.content[first + k : first + k + 1])
                b.append(held.content[first + o : first + o + 1])
                joined[joined == joined[o]] = joined[k]
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))


def group_links(rows: DataFrame, members: DataFrame, sided: bool = False) -> DataFrame:
    """Links a, b of contents in the same group. rows: band, one and two (the blocks that meet), left_side, content, low, component."""
    full = rows.join(members, "content").withColumn("group", F.xxhash64("band", "one", "two"))
    dealt = full.repartition("group").sortWithinPartitions("group", F.desc(F.length("members")), "content").select("group", "content", "low", "left_side", "component", "members")

    def run(batches):
        for table in whole_groups(batches, "group"):
            a, b = links_within(Held(table), sided)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return mapped(dealt, run, "a long, b long")


def live_bands(contents: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each band of each content (band, content, low, c: the band's contents) where contents of different smallest doc_ids meet; others have no
    links. Of bands with the very same contents one is left: near copies meet in most of their bands."""
    own = Window.partitionBy("band")
    rows = contents.where(f"{KEYS[0]} is not null").select(F.explode(F.array(*KEYS)).alias("band"), "content", "low")
    rows = rows.withColumn("least", F.min("low").over(own)).withColumn("most", F.max("low").over(own)).withColumn("c", F.count(F.lit(1)).over(own))
    rows = rows.withColumn("own", F.bit_xor(F.xxhash64("content")).over(own)).where("least <> most")
    rows = scratch.save(rows.select("band", "content", "low", "c", "own"), "live")
    first = rows.groupBy("band", "c", "own").agg(F.lit(1).alias("one")).groupBy("c", "own").agg(F.min("band").alias("band"))
    return rows.join(first.select("band"), "band", "left_semi").select("band", "content", "low", "c")


def near_links(docs: DataFrame, table: DataFrame, contents: DataFrame, scratch: Scratch) -> DataFrame:
    """Links of contents that have the similarity: every pair that meets in a band and has it stands in one component.

    A band of up to BLOCK contents is one group. Longer ones are dealt in blocks: first each block by itself; then, with what that has joined, the
    contents outside the band's largest component, in blocks, against all blocks. No task holds more than two blocks, and only
    links that join something leave it."""
    rows = scratch.save(live_bands(contents, scratch).withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("one", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")), "bands")
    scratch.drop("live")
    # a content's place in its smallest doc_id: joined by both, so that the copies of a content don't meet in one task
    wanted = rows.select("content", F.col("low").alias("doc_id")).distinct()
    places = table.where(f"{KEYS[0]} is not null").join(wanted, ["content", "doc_id"], "left_semi").groupBy("content", "doc_id").agg(F.min(F.struct("mark", "start", "length")).alias("at")).select("doc_id", "at.*", "content")
    places = scratch.save(places, "places")
    members = scratch.save(members_of(docs, places).groupBy("content").agg(F.max("members").alias("members")), "members")
    alone = F.lit(0).cast("long")
    links = durable(group_links(rows.select("band", "one", F.col("one").alias("two"), F.lit(False).alias("left_side"), alone.alias("component"), "content", "low"), members).distinct())
    long = rows.where("blocks > 1")
    if long.limit(1).count():
        parts = connected_components(links)
        placed = long.join(parts, F.col("content") == F.col("node"), "left").withColumn("component", F.coalesce("component", "content")).drop("node")
        placed = durable(placed)
        sizes = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), (F.sum("n") - F.max("n")).alias("rest")).where("rest > 0")
        placed = placed.join(sizes.select("band", "largest", F.ceil(F.col("rest") / BLOCK).cast("int").alias("left_blocks")), "band")
        left = placed.where("component <> largest").select("band", F.pmod(F.xxhash64("content"), F.col("left_blocks")).cast("int").alias("one"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("two"), F.lit(True).alias("left_side"), "component", "content", "low")
        both = left.unionByName(placed.select("band", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("one"), F.col("one").alias("two"), F.lit(False).alias("left_side"), "component", "content", "low"))
        links = links.unionByName(durable(group_links(both, members, True).distinct()))
    scratch.drop("members", "bands", "places")
    return links


# -- what goes


def merged(spans: list[tuple]) -> list[tuple]:
    """Sorted spans (start, end, component, keeper), those that overlap or touch as one with the component and keeper of the one with
    the smallest keeper (the first of these): a larger keeper may lose the passage to it. Without keepers, the first's component."""
    out: list[tuple] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            rest = s[2:] if len(s) > 3 and s[3] < out[-1][3] else out[-1][2:]
            out[-1] = (out[-1][0], max(out[-1][1], s[1]), *rest)
        else:
            out.append(s)
    return out


def edge(found: list[tuple], span: tuple, left: bool) -> tuple:
    """Place and content of the paragraph nearest to a span's end of those that its keeper has word for word; nulls if none is near."""
    start, end = span[:2]
    own = [p for p in found if start <= p["start"] < end and p["exact"] and p["keep_id"] == span[3]]
    if left and (best := min(own, key=lambda p: p["start"], default=None)) and best["start"] - start < CONTEXT:
        return best["start"], best["content"]
    if not left and (best := max(own, key=lambda p: p["start"] + p["length"], default=None)) and end - best["start"] - best["length"] < CONTEXT:
        return best["start"] + best["length"], best["content"]
    return None, None


def spans_of(gone: DataFrame) -> DataFrame:
    """The paragraphs of each text that go as spans, with the paragraphs at their ends that the keeper has too."""
    names = ["doc_id", "mark", "start", "end", "component_id", "keep_id", "left_at", "left_content", "right_at", "right_content"]

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for s in merged([(p["start"], p["start"] + p["length"], p["component_id"], p["keep_id"]) for p in found]):
                    out.append((doc, mark, *s, *edge(found, s, True), *edge(found, s, False)))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    grouped = gone.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "length", "component_id", "keep_id", "content", "exact")).alias("found"))
    return mapped(grouped, run, ", ".join(f"{n} long" for n in names))


def contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """doc_id, mark, at, side, content, keeper and context (hashes of the CONTEXT words from a place outwards) of places in texts."""

    def answer(w, text, doc, mark, at, side, content, keeper):
        step = np.arange(CONTEXT)
        place = np.where(side[:, None] == 0, at[:, None] - 1 - step, at[:, None] + step)
        inside = (place >= 0) & (place < np.diff(w.offsets)[text][:, None])
        found = (w.hashes[np.where(inside, place + w.offsets[text][:, None], 0)] >> np.uint64(32)).astype(np.uint32) | np.uint32(2)
        data = np.where(inside, found, keeper[:, None].astype(np.uint32)).astype("<u4").tobytes()  # beyond a text, its numbers equal no other's
        offsets = (np.arange(len(text) + 1) * 4 * CONTEXT).astype(np.int32)
        context = pa.Array.from_buffers(pa.binary(), len(text), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (doc, mark, at, side, content, keeper)], context], names=["doc_id", "mark", "at", "side", "content", "keeper", "context"])

    fields = ["doc", "of", "at", "side", "content", "keeper"]
    return asked_texts(docs, asked.withColumn("doc", F.col("doc_id")).withColumn("of", F.col("mark")), fields, answer, "doc_id long, mark long, at long, side long, content long, keeper long, context binary")


def agreements(docs: DataFrame, spans: DataFrame, places: DataFrame) -> DataFrame:
    """How many words beyond each end of the spans the texts agree with their keepers': doc_id, mark, at, side, words. Keepers' words move,
    a few for each content, never their texts; a common content's rows are split by Spark's skew join."""
    side = lambda at, content, number: spans.select("doc_id", "mark", F.col(at).alias("at"), F.lit(number).alias("side"), F.col(content).alias("content")).where("at is not null")
    own = durable(side("left_at", "left_content", 0).unionByName(side("right_at", "right_content", 1)).distinct())
    needed = own.select("content", "side").distinct()
    kept = places.where("doc_id = keep_id").select("doc_id", "mark", "start", "length", "content").distinct().join(needed, "content")
    kept = kept.select("doc_id", "mark", (F.col("start") + F.when(F.col("side") == 1, F.col("length")).otherwise(0)).alias("at"), "side", "content")
    found = durable(contexts(docs, own.withColumn("keeper", F.lit(0)).unionByName(kept.withColumn("keeper", F.lit(1)))))
    theirs = found.where("keeper = 1").select("content", "side", F.col("context").alias("other")).distinct()
    both = found.where("keeper = 0").join(theirs, ["content", "side"]).select("doc_id", "mark", "at", "side", "context", "other")

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, CONTEXT) for i in (4, 5))
            same = np.concatenate([a == b, np.zeros((len(a), 1), bool)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(same.argmin(axis=1), pa.int64())], names=["doc_id", "mark", "at", "side", "words"])

    return mapped(both, run, "doc_id long, mark long, at long, side long, words long").groupBy("doc_id", "mark", "at", "side").agg(F.max("words").alias("words"))


def extended(docs: DataFrame, spans: DataFrame, places: DataFrame) -> DataFrame:
    """Spans that reach as far as the texts agree with their keepers'; those that then overlap or touch are one."""
    found = durable(agreements(docs, spans, places))
    for name, number in (("left", 0), ("right", 1)):
        one = found.where(F.col("side") == number).select("doc_id", "mark", F.col("at").alias(f"{name}_at"), F.col("words").alias(f"{name}_words"))
        spans = spans.join(one, ["doc_id", "mark", f"{name}_at"], "left")
    start = F.least("start", F.col("left_at") - F.coalesce("left_words", F.lit(0)))
    end = F.greatest("end", F.col("right_at") + F.coalesce("right_words", F.lit(0)))
    wide = spans.select("doc_id", "mark", F.struct(start.alias("start"), end.alias("end"), "component_id", "keep_id").alias("s"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out += [(doc, mark, s[0], s[1] - s[0], *s[2:]) for s in merged([(p["start"], p["end"], p["component_id"], p["keep_id"]) for p in found])]
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "mark", "start", "length", "component_id", "keep_id"])

    return mapped(wide.groupBy("doc_id", "mark").agg(F.collect_list("s").alias("found")), run, "doc_id long, mark long, start long, length long, component_id long, keep_id long")


def removals(docs: DataFrame) -> DataFrame:
    """What to remove so that each passage that repeats across documents stays in one.

    Texts are parted once into paragraphs that overlap freely: windows of 24 words at places that the words themselves choose,
    so every passage of 50 words or more holds windows that come out alike in each of its copies, wherever it stands; lines of
    24 to 256 words; and chunks of 53 words or more between places that the words choose. Equal paragraphs are one content.
    Lines and chunks, which can be alike with a word changed inside, meet in MinHash bands tuned for the recall; every pair that meets and
    isn't joined already is verified by the exact Jaccard similarity (0.8) of its five-word shingles (as hashes of 32 bits); links make components. Of a
    component's paragraphs, those of its smallest doc_id stay; all others go, with the words around them as far as these agree with
    the text that stays. Repeats inside one document stay.

    Returns doc_id, mark (a hash that tells texts of one doc_id apart), start and length (in words; spans that overlap or
    touch are one), component_id (a paragraph content of the keeper's first component), keep_id (the doc_id that keeps it). Texts
    of under 24 words, null texts and rows with a null doc_id have no paragraphs. Repeated doc_ids: the rows are one
    document, none is held against another. An empty table gives no rows. Long texts are parted like others. Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession)
    try:
        return _removals(docs, scratch)
    finally:
        scratch.drop()


def _removals(docs: DataFrame, scratch: Scratch) -> DataFrame:
    table = scratch.save(paragraph_table(docs), "paragraphs")
    contents = table.groupBy("content").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), *[F.max(k).alias(k) for k in KEYS])
    contents = scratch.save(contents.where(f"{KEYS[0]} is not null or low <> high"), "contents")
    parts = connected_components(near_links(docs, table, contents, scratch))
    shared = contents.join(parts, F.col("content") == F.col("node"), "left").where("low <> high or component is not null")
    shared = durable(shared.select("content", "low", "high", F.coalesce("component", "content").alias("component_id")))
    scratch.drop("contents")
    keep = shared.groupBy("component_id").agg(F.min("low").alias("keep_id"), F.max("high").alias("last_id")).where("keep_id <> last_id").drop("last_id")
    target = durable(shared.join(keep, "component_id").select("content", "component_id", "keep_id", (F.col("low") == F.col("keep_id")).alias("exact")))
    places = durable(table.select("doc_id", "mark", "start", "length", "content").join(small_side(target, BROADCAST_ROWS), "content"))
    scratch.drop("paragraphs")
    spans = durable(spans_of(places.where("doc_id <> keep_id")))
    return durable(extended(docs, spans, places))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans (first word, number of words) and the white space after them."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, at = [], 0
    for first, n in sorted(spans):
        out.append(text[at : words[first][0]])
        at = words[first + n][0] if first + n < len(words) else len(text)
    return b"".join([*out, text[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs, all columns, with the passages of `removals` cut from the texts; n_chars, where there is one, follows the text.

    Null texts, null doc_ids and empty tables stay as they are; of repeated doc_ids each row loses what its own text holds."""
    spans = durable(removals(docs).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "length")).alias("spans")))
    names = docs.columns
    side = small_side(spans.select(F.col("doc_id").alias("spans_of"), "mark", "spans"), 20_000)
    taken = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text, key = (f"c{[n.lower() for n in names].index(c)}" for c in ("text", "doc_id"))
    joined = taken.join(side.groupBy("spans_of").agg(F.collect_list(F.struct("mark", "spans")).alias("marks")), F.col(key).cast("long") == F.col("spans_of"), "left")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, marks = part.column(0).to_pylist(), part.column(1).to_pylist()
                out = []
                for t, m in zip(texts, marks, strict=True):
                    if m and t is not None:
                        data = t.encode()
                        own = [x["spans"] for x in m if x["mark"] == text_mark(data)]
                        t = cut(data, [(s["start"], s["length"]) for s in own[0]]).decode() if own else t
                    out.append(t)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *part.columns[2:]], names=[text, *others])

    others = [f"c{i}" for i in range(len(names)) if f"c{i}" != text]
    fields = {f.name: f.dataType.simpleString() for f in taken.schema.fields}
    done = mapped(joined.select(text, "marks", *others), run, ", ".join(f"{c} {fields[c]}" for c in (text, *others)))
    count = [i for i, n in enumerate(names) if n.lower() == "n_chars"]
    new = {f"c{i}": F.coalesce(F.length(text), F.lit(0)).cast(fields[f"c{i}"]) for i in count}
    return done.select(*[new.get(f"c{i}", F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])
