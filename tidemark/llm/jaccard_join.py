"""Documents whose sets of word shingles have a high Jaccard similarity, by a size-aware heavy-light join."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, durable, lists, mapped, mix, shingle_hashes, signed, small_side, text_blocks, whole_groups, word_hashes
from tidemark.operators.components import connected_components

#: Frequent shingles that are known by their counts, which orders the inverted lists; a bound on what is broadcast.
FREQUENT = 1 << 18
#: Shingles of a task that are counted at once, and the most subsets by which a small set may be known.
COUNTED, MOST_SUBSETS = 2_000_000, 128
#: What a turn must lessen the pairs that are left to, for another to follow.
WORTH = 0.7
#: Documents before it in a list that a document is tried with at each turn.
NEAR = 3
#: Pairs for each posting up to which all that are left are tried, and turns along the lists at most before they are.
PAIRS_PER_POSTING, TURNS = 4, 6
#: Documents of a list that stand in one chain, and that are held against each other at once; longer lists are dealt in blocks.
CHAIN, BLOCK = 256, 1024
#: Cells of the sketch that bounds overlaps: members of a set by their hash.
CELLS = 128
#: Ids that may be broadcast.
BROADCAST_IDS = 200_000
SALTS = 16


def least_overlap(n: int, percent: int) -> int:
    """Fewest members that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct k-word shingles of each text as sorted 64-bit hashes."""
    words, offsets = word_hashes(texts)
    return [np.unique(shingle_hashes(words[a:b], k)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted) with their counts.

    Tasks count large runs of their shingles and report those found more than once in a run, so a count is a lower bound. They
    only set the order in which the join looks at shingles: its result doesn't depend on them."""

    def run(batches):
        held, size = [], 0

        def counted():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return found[n > 1], n[n > 1]

        def out(found, n):
            return pa.RecordBatch.from_arrays([pa.array(signed(found), pa.int64()), pa.array(n, pa.int64())], names=["token", "n"])

        for _, texts in text_blocks(batches):
            sets = shingle_sets(texts, k)
            held += sets
            size += sum(map(len, sets))
            if size >= COUNTED:
                yield out(*counted())
                held, size = [], 0
        if held:
            yield out(*counted())

    counts = durable(mapped(_plain(docs), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    # the lowest step of counts from which on there are few enough; steps of a tenth, so there are some hundreds at most
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.1)))
    steps, room, least = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect(), FREQUENT, None
    for row in steps:
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    top = counts.where((step >= least) if least is not None else F.lit(False)).toPandas()
    tokens, n = top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def enumerated(n: int, percent: int) -> int:
    """Subsets that a small set of n is known by: all that leave out as many members as a link allows."""
    return sum(comb(n, j) for j in range(n - least_overlap(n, percent) + 1))


def largest_small(percent: int) -> int:
    """The largest size up to which every set has MOST_SUBSETS enumerated subsets at most."""
    n = 1
    while enumerated(n + 1, percent) <= MOST_SUBSETS:
        n += 1
    return n


def boundary(sizes: dict[int, tuple[int, float]], percent: int) -> int:
    """The size that parts small from large sets, of all that may be the one with the least cost (the larger of equal ones).

    sizes: for each size, how many sets there are and what scanning the inverted lists of their prefixes costs. Small sets cost
    their enumerated subsets. Lists hold the large sets and those small ones that a large set can link with."""

    def cost(small: int) -> float:
        listed = least_overlap(small + 1, percent)
        return sum((count * enumerated(n, percent) if n <= small else 0) + (scan if n >= listed else 0) for n, (count, scan) in sizes.items())

    return min(range(1, largest_small(percent) + 1), key=lambda small: (cost(small), -small))


def scan_costs(reps: DataFrame, listed: DataFrame, percent: int) -> dict[int, tuple[int, float]]:
    """For each size up to the largest that may be small: its sets, and the cost of their lists as measured: a step for each posting and
    for each other set in its list, which then is compared member by member."""
    most = largest_small(percent)
    counts = dict(reps.where(F.col("n").between(1, most)).groupBy("n").count().collect())
    others = dict(listed.where(F.col("n").between(1, most)).groupBy("n").agg(F.sum(((F.col("c") - 1) * (F.col("n") + 1)).cast("double"))).collect())
    return {n: (count, count * (n - least_overlap(n, percent) + 1) + others.get(n, 0.0)) for n, count in counts.items()}


def subset_keys(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A key (sum of mixed members) and the size of every enumerated subset."""
    n = len(tokens)
    parts = mix(tokens)
    whole = parts.sum(dtype=np.uint64, keepdims=True)
    keys, sizes = [], []
    for j in range(n - least_overlap(n, percent) + 1):
        for left_out in combinations(range(n), j):
            keys.append(whole - parts[list(left_out)].sum(dtype=np.uint64, keepdims=True))
            sizes.append(n - j)
    return mix(np.concatenate(keys) + np.array(sizes, np.uint64)), np.array(sizes, np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """How many members of a set fall into each cell: two sets share no more than the smaller number of every cell."""
    return np.bincount((tokens >> np.uint64(57)).astype(np.int64), minlength=CELLS).astype(np.uint32).tobytes()


def described(docs: DataFrame, k: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Of each document: the size of its set, two hashes of the whole set, subset keys if it may count as small, and the prefix of its
    shingles (rare ones first) that any link must share one of."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    small = largest_small(percent)

    def run(batches):
        known, counts = shared.value
        none = np.zeros(0, np.int64)
        for ids, texts in text_blocks(batches):
            sets = shingle_sets(texts, k)
            one, two, keys, sizes, prefixes = [], [], [], [], []
            for s in sets:
                one.append(int(signed(mix(s + np.uint64(1)).sum(dtype=np.uint64, keepdims=True))[0]))
                two.append(int(signed(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True))[0]))
                a, b = subset_keys(s, percent) if 0 < len(s) <= small else (none, none)
                keys.append(signed(a))
                sizes.append(b)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    s = s[np.argsort(np.where(known[at] == s, counts[at], 0), kind="stable")]
                prefixes.append(signed(s[: len(s) - least_overlap(len(s), percent) + 1]) if len(s) else none)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(map(len, sets), pa.int64(), size=len(sets)), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists(keys, pa.int64()), lists(sizes, pa.int64()), lists(prefixes, pa.int64()), pa.array(map(sketch, sets), pa.binary(), size=len(sets))],
                names=["doc_id", "n", "one", "two", "keys", "sizes", "prefix", "cells"],
            )

    return mapped(_plain(docs), run, "doc_id long, n long, one long, two long, keys array<long>, sizes array<long>, prefix array<long>, cells binary")


def small_links(reps: DataFrame, percent: int) -> DataFrame:
    """Candidate links between sets that share an enumerated subset of x members: if sizes a and b let x members link them, so do
    they let either link with the smallest set of that subset, so a link of each with that one loses no connection."""
    rows = reps.select("doc_id", "n", F.explode(F.arrays_zip("keys", "sizes")).alias("s")).select("doc_id", "n", F.col("s.keys").alias("key"), F.col("s.sizes").alias("x"))
    first = rows.groupBy("key", "x").agg(F.min(F.struct("n", "doc_id")).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
    met = rows.join(first, ["key", "x"]).select("doc_id", "n", "x", F.col("f.doc_id").alias("first"), F.col("f.n").alias("m"))
    ok = (F.col("first") != F.col("doc_id")) & (100 * F.col("x") >= percent * (F.col("m") + F.col("n") - F.col("x")))
    return met.where(ok).select(F.least("first", "doc_id").alias("a"), F.greatest("first", "doc_id").alias("b"))


def may_link(n, i, m, j, percent: int):
    """Whether sets of n and m members whose first common shingle stands at places i and j can have the similarity."""
    return (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)


def placed(postings: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Postings with the component of their document so far, the document itself before there are any."""
    if parts is None:
        return postings.withColumn("component", F.col("doc_id"))
    return postings.join(parts.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def list_links(rows: DataFrame, percent: int, turn: int, near: int = NEAR) -> DataFrame:
    """Candidate links between components along the inverted lists, as many as a list is long: each document with the `near` before
    it (by size at first, in another random order at each turn), and with the one in which the list's shingle stands
    earliest, which has the fewest rare shingles of its own and so is nearest to the others. Long lists are parted into chains, other ones at each turn."""
    order = [F.col("n"), F.col("doc_id")] if not turn else [F.xxhash64("doc_id", F.lit(turn)), F.col("doc_id")]
    chain = Window.partitionBy("token", "part").orderBy(*order)
    lists = rows.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.min(F.struct("i", "n", "doc_id", "component")).alias("o0")).where("least <> most")
    mixed = rows.join(lists.drop("least", "most"), "token").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(-turn)), F.ceil(F.col("c") / CHAIN)))
    one = F.struct("i", "n", "doc_id", "component")
    mixed = mixed.withColumns({f"o{d}": F.lag(one, d).over(chain) for d in range(1, near + 1)})
    pairs = mixed.select("doc_id", "n", "i", "component", F.explode(F.array_distinct(F.array_compact(F.array(*[f"o{d}" for d in range(near + 1)])))).alias("o"))
    ok = (F.col("o.component") != F.col("component")) & may_link(F.col("n"), F.col("i"), F.col("o.n"), F.col("o.i"), percent)
    return pairs.where(ok).select(F.least("o.doc_id", "doc_id").alias("a"), F.greatest("o.doc_id", "doc_id").alias("b"))


def mixed_lists(rows: DataFrame) -> DataFrame:
    """The lists whose documents are in several components: the largest of these, the documents in it and in all. Short lists, of
    which the first turn has tried every pair, are left out."""
    sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"))
    return sizes.groupBy("token").agg(F.max_by("component", F.struct("c", "component")).alias("largest"), F.max("c").alias("own"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("k")).where(f"k > 1 and all > {NEAR + 1}")


def remaining_links(rows: DataFrame, mixed: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """All candidate links that are left between documents of different components and that the sketches don't rule out. Lists in one
    component have none; in the others, documents outside the largest component are held against all, so a group that is joined
    already isn't paired with itself. Long lists are dealt in blocks, two of which meet in a task; only pairs that may have the similarity leave it."""
    rows = rows.join(mixed.select("token", "largest", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")), "token")
    rows = rows.join(reps.select("doc_id", "cells"), "doc_id").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn("large", F.col("component") == F.col("largest"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.where("not large").select("*", other.alias("that"), F.lit(True).alias("left_side")).withColumn("group", F.xxhash64("token", "own", "that"))
    right = rows.select("*", other.alias("that"), F.lit(False).alias("left_side")).withColumn("group", F.xxhash64("token", "that", "own"))
    names = ["group", "left_side", "large", "doc_id", "n", "i", "component", "cells"]
    dealt = left.select(*names).unionByName(right.select(*names)).repartition("group").sortWithinPartitions("group")

    def run(batches):
        for table in whole_groups(batches, "group", 2048):
            group, side, large, doc, n, i, component = (table.column(c).to_numpy() for c in names[:-1])
            cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint32).reshape(-1, CELLS)
            begin = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
            a, b = [], []
            for first, last in zip(begin, np.append(begin[1:], len(group)), strict=True):
                own = np.arange(first, last)
                against = own[~side[own]]
                for k in own[side[own]]:
                    r = against[(component[against] != component[k]) & (large[against] | (doc[against] > doc[k]))]
                    r = r[(100 + percent) * np.minimum(n[k] - i[k], n[r] - i[r]) >= percent * (n[k] + n[r])]
                    r = r[(100 + percent) * np.minimum(cells[r], cells[k]).sum(axis=1, dtype=np.int64) >= percent * (n[k] + n[r])]
                    a.append(np.minimum(doc[r], doc[k]))
                    b.append(np.maximum(doc[r], doc[k]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)) for x in (a, b)], names=["a", "b"])

    return mapped(dealt, run, "a long, b long")


def possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches don't rule the similarity out, which leaves few but the true ones to be verified on whole sets."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, CELLS) for c in ("x", "y"))
            total = batch.column("total").to_numpy()
            ok = (100 + percent) * np.minimum(a, b).sum(axis=1) >= percent * total
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    side = lambda key, cells, size: reps.select(F.col("doc_id").alias(key), F.col("cells").alias(cells), F.col("n").alias(size))
    both = pairs.join(side("a", "x", "m"), "a").join(side("b", "y", "n"), "b").select("a", "b", "x", "y", (F.col("m") + F.col("n")).alias("total"))
    return mapped(both, run, "a long, b long").distinct()


def verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The candidate pairs that have the similarity, by the exact overlap of their sets. pairs: distinct, and cheap to read."""
    wanted = durable(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())

    def run(batches):
        for ids, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists([signed(s) for s in shingle_sets(texts, k)], pa.int64())], names=["id", "members"])

    texts = _plain(docs).join(small_side(wanted, BROADCAST_IDS), F.col("doc_id") == F.col("id"), "left_semi")
    sets = scratch.save(mapped(texts, run, "id long, members array<long>"), f"sets-{name}")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    linked = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    out = durable(linked.where(f"{100 + percent} * shared >= {percent} * total").select("a", "b").distinct())
    scratch.drop(f"sets-{name}")
    return out


def similar_groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """The groups of documents that links join, where two documents link if 100 * intersection >= percent * union of their sets.

    Sets are distinct k-word shingles of the text, A-Z lower-cased; of fewer words, the whole sequence; without words, none,
    which links with nothing. Equal sets are one class from the start (salted, so that a group of any size is spread), and
    one representative of each goes on. Small sets meet by enumerated subsets, large ones by the inverted lists of the
    shingles that a link must share one of, rare shingles first; the size that parts them is the one with the least cost, measured
    on the lists. Candidates are first tried along each list (linear in its length) and joined into components, turn by
    turn until few pairs are left between components; then each of these is tried, so no link between components is lost. Each candidate is
    verified on the whole sets. Sets are of 64-bit hashes of shingles.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included). Null text: no words. Null
    doc_id: takes part in no link of its own but shares its equal sets' component (null if they have none). Rows that repeat
    a doc_id are one document: their sets' components are joined. Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession)
    try:
        return _similar_groups(docs, k, percent, scratch)
    finally:
        scratch.drop()


def _similar_groups(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    rows = scratch.save(described(docs, k, percent, frequent_shingles(docs, k)), "sets")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    key = ["n", "one", "two"]
    salted = rows.where("n > 0").groupBy(*key, "salt").agg(F.min("doc_id").alias("least"))
    classes = durable(salted.withColumn("rep", F.min("least").over(Window.partitionBy(*key))).drop("least"))
    reps = rows.join(classes.where("rep is not null").groupBy(*key).agg(F.min("rep").alias("rep")).withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi")
    reps = scratch.save(reps.drop("one", "two", "salt"), "reps")
    rows = scratch.save(rows.select("doc_id", *key, "salt"), "ids")
    scratch.drop("sets")
    listed, small = inverted_lists(reps, percent, scratch)
    # a doc_id with several texts ties its classes
    tied = rows.where("doc_id is not null").join(classes, [*key, "salt"]).where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    tied = durable(tied.join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("doc_id").alias("b")), "b", "left_semi").select("a", "b"))
    tried, links, parts, turn, before = None, tied, None, 0, None
    while True:
        here = durable(placed(listed, parts)) if turn else placed(listed, None)
        mixed = durable(mixed_lists(here)) if turn else None
        # all pairs that are left are tried once they are about as many as a turn tries, or turns don't lessen them any more
        rest, length = mixed.agg(F.sum(F.expr("(all - own) * all")), F.sum("all")).first() if turn else (None, None)
        few, slow = (rest or 0) <= PAIRS_PER_POSTING * (length or 0), before is not None and rest > WORTH * before
        last, before = turn > 0 and (few or slow or turn == TURNS), rest
        new = remaining_links(here, mixed, reps, percent) if last else list_links(here, percent, turn)
        if not turn:
            new = new.unionByName(small_links(reps.where(F.col("n") <= small), percent))
        new = new.distinct()
        new = durable(new.join(tried, ["a", "b"], "left_anti") if turn else new)
        if new.limit(1).count():
            links = links.unionByName(verified(docs, new if last else durable(possible(new, reps, percent)), k, percent, scratch, f"turn-{turn}"))
        parts = durable(connected_components(links))
        if last:
            break
        tried = new if tried is None else tried.unionByName(new)
        turn += 1
    ids = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(*key, "salt", F.coalesce("component", "rep").alias("component_id"))
    return durable(rows.select("doc_id", *key, "salt").join(ids, [*key, "salt"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def inverted_lists(reps: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """The inverted lists of two sets or more (doc_id, n, place i of the shingle in its prefix, token, c: the list's sets), and the size up to
    which sets are small, by the cost of these lists; lists then hold what a large set can link with."""
    postings = reps.select("doc_id", "n", F.posexplode("prefix").alias("i", "token"))
    listed = scratch.save(postings.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("c > 1"), "lists")
    small = boundary(scan_costs(reps, listed, percent), percent)
    return listed.where(F.col("n") >= least_overlap(small + 1, percent)), small


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, without those that `similar_groups` finds to be in the group of a smaller doc_id. Rows
    without words or with a null doc_id all stay."""
    groups = similar_groups(docs, k, percent)
    gone = durable(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct())
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc_id = f"c{[n.lower() for n in names].index('doc_id')}"
    side = small_side(gone, BROADCAST_IDS)
    return plain.join(side, plain[doc_id].cast("long") == side["gone_id"], "left_anti").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
