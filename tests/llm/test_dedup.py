import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, jaccard_join, substring_dedup
from tidemark.operators.components import connected_components

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return fold(text).encode().split()


# -- components


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    for n, m in ((30, 20), (200, 150), (60, 300)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1080)] + [(None, 3)]
        rows = spark.createDataFrame(links, "a long, b long")
        got = {r.node: r.component for r in connected_components(rows, one_task=0).collect()}
        assert got == {r.node: r.component for r in connected_components(rows).collect()}
        near = defaultdict(set)
        for a, b in links:
            if a is not None and a != b:
                near[a].add(b)
                near[b].add(a)
        for node in near:
            seen, todo = {node}, [node]
            while todo:
                for x in near[todo.pop()] - seen:
                    seen.add(x)
                    todo.append(x)
            assert got[node] == min(seen)
        assert set(got) == set(near)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- exact duplicates


def exact_model(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[fold(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (2, "A B"), (3, "a  b"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "x" * 200_000), (9, "X" * 200_000), (None, "a b"), (None, "lone"), (10, "k"), (10, "k"), (10, "other")]


@pytest.mark.parametrize("digest", [None, lambda t: F.length(t) % 2])
def test_exact_dedup(spark, digest):
    """Also with digests that collide: texts are compared."""
    got = exact_dedup.exact_dedup(frame(spark, ROWS), 4, *([digest] if digest else [])).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_model(ROWS)
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({fold(t) for _, t in ROWS})


def test_exact_dedup_plan_has_no_python(spark):
    plan = exact_dedup.exact_dedup(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_exact_dedup_of_nothing_and_with_other_columns(spark):
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    clash = frame(spark, [(1, "a", "d", 2, True), (2, "A", "e", 3, False)], "doc_id long, text string, digest string, salt int, kept boolean")
    assert {r.doc_id: r.kept for r in exact_dedup.exact_dedup(clash).collect()} == {1: False, 2: True}
    stay = exact_dedup.keep_first(clash)
    assert stay.columns == clash.columns and [r.doc_id for r in stay.collect()] == [2]


def test_keep_first_keeps_one_of_each(spark):
    kept = [(r.doc_id, fold(r.text)) for r in exact_dedup.keep_first(frame(spark, ROWS)).collect()]
    assert sorted(t for _, t in kept) == sorted({fold(t) for _, t in ROWS})


# -- similar documents


def jaccard_model(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                shared = len(sets[x] & sets[y])
                if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, size, length, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            copy = copy[rng.randrange(3) :]
        yield " ".join(copy)


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 60)])
def test_similar_groups_against_all_pairs(spark, k, percent):
    rng = random.Random(k)
    texts = [None, "", "  ", "a", "A", "a b c", "a b c d", "a b c d e"]
    for length, edits in ((4, 1), (8, 1), (14, 2), (20, 2), (60, 3), (150, 5)):
        texts += family(rng, 12, length, edits)
    texts += list(family(rng, 60, 100, 3))  # a large group of near copies
    common = " ".join(f"c{i}" for i in range(30))  # a passage that many texts share
    texts += [" ".join([*(f"u{rng.randrange(10**6)}" for _ in range(12)), common]) for _ in range(40)]
    rows = list(enumerate(texts + texts[20:30]))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(frame(spark, rows), k, percent).collect()}
    assert got == jaccard_model(rows, k, percent)


def test_boundary_follows_the_cost():
    """Longer lists make more sets small, and the boundary is the cheapest of all."""
    assert [jaccard_join.largest_small(p) for p in (85, 80)] == [15, 14]
    found = []
    for length in (1, 3, 100):
        sizes = {n: (50, 50.0 * (n - jaccard_join.least_overlap(n, 85) + 1) * length) for n in range(1, 16)}
        found.append(jaccard_join.boundary(sizes, 85))
    assert found == sorted(found) and found[0] < 7 <= found[-1]
    assert jaccard_join.boundary({}, 85) == 15


def test_both_halves_find_links(spark):
    """Where short texts have many near copies, the boundary measured on the lists makes them small; both halves then find links.
    (In sf0.1 no two different sets of up to 15 shingles link, so lists alone find links there, whatever the boundary.)"""
    from tidemark.llm.common import Scratch

    rng, scratch = random.Random(12), Scratch(spark)
    short = [[*prose(rng, 15), f"last{i}"] for i in range(40)]
    texts = [" ".join([*t[:-1], f"{t[-1]}-{j}"]) for t in short for j in range(5)] + [t for _ in range(20) for t in family(rng, 3, 80, 1)]
    docs = frame(spark, list(enumerate(texts)))
    rows = jaccard_join.described(docs, 4, 85, jaccard_join.frequent_shingles(docs, 4)).dropDuplicates(["n", "one", "two"])
    reps = scratch.save(rows, "reps")
    listed, small = jaccard_join.inverted_lists(reps, 85, scratch)
    by_subset = jaccard_join.small_links(reps.where(F.col("n") <= small), 85).distinct().count()
    by_list = jaccard_join.possible(jaccard_join.list_links(jaccard_join.placed(listed, None), 85, 0).distinct(), reps, 85).count()
    scratch.drop()
    assert 13 <= small <= 15 and by_subset >= 160 and by_list > 0
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(docs).collect()}
    assert got == jaccard_model(list(enumerate(texts)), 4, 85)


@pytest.mark.parametrize("chain, block", [(256, 1024), (4, 5)])
def test_pairs_left_in_long_lists(spark, monkeypatch, chain, block):
    """Unlike documents share a phrase of common shingles, and near copies stand far from each other in its lists."""
    monkeypatch.setattr(jaccard_join, "CHAIN", chain)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "TURNS", 1)
    rng = random.Random(11)
    phrase, rows = [f"p{i}" for i in range(30)], []
    for i in range(60):
        own = [f"o{i}-{j}" for j in range(8)]
        rows += [(2 * i, " ".join([*own, *phrase])), (2 * i + 1, " ".join([*own, *phrase[:-1], f"x{i}"]))]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(frame(spark, rows), 4, 85).collect()}
    assert got == jaccard_model(rows, 4, 85)


def test_similar_groups_of_odd_rows(spark):
    assert jaccard_join.similar_groups(frame(spark, [])).count() == 0
    rows = [(None, "p q r s t u"), (3, "p q r s t u"), (None, "alone here"), (4, None), (5, "one two"), (5, "three four"), (6, "three four")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 3, 3), (3, 3, 3), (None, 1, None), (4, 0, 4), (5, 1, 5), (5, 1, 5), (6, 1, 5)], key=str)
    clash = frame(spark, [(1, "a b c d e f", 1), (2, "A b c d e f", 2)], "doc_id long, text string, n int")
    kept = jaccard_join.keep_one(clash)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [1]


# -- repeated passages


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**7)}" for _ in range(n)]


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(3)
    passage, longer = prose(rng, 51), prose(rng, 140)
    texts = {i: prose(rng, 80 + rng.randrange(200)) for i in range(60)}
    for i in range(0, 20):
        at = rng.randrange(len(texts[i]))
        texts[i][at:at] = passage
    for i in range(15, 30):
        at = rng.randrange(len(texts[i]))
        near = list(longer)
        near[70] = f"edit{i}"
        texts[i][at:at] = near
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(100, None), (101, ""), (102, "short text"), (None, " ".join(passage))]
    gone = substring_dedup.removals(frame(spark, rows)).collect()
    assert {r.doc_id for r in gone} == set(range(1, 30)) - {15} | {15}
    assert all(r.keep_id in (0, 15) and r.keep_id != r.doc_id for r in gone)
    cut = {r.doc_id: r.text for r in substring_dedup.without_repeats(frame(spark, rows)).collect() if r.doc_id is not None}
    assert cut[0] == rows[0][1] and all(cut[i] == rows[i][1] for i in range(30, 60))
    whole = [i for i in range(1, 20) if " ".join(passage) in " ".join(texts[i])]  # the other insertion can part it
    assert len(whole) > 14 and all(not set(passage) & set(cut[i].split()) for i in whole)  # to the last word
    middle = " ".join(longer[20:60])
    assert [i for i in range(15, 30) if middle in cut[i]] == [15]
    assert all(set(cut[i].split()) <= set(texts[i]) for i in range(60))


def test_repeats_inside_one_document_stay(spark):
    rng = random.Random(4)
    p = " ".join(prose(rng, 60))
    rows = [(1, f"{p} x {p}"), (2, "same " * 300), (3, " ".join(prose(rng, 100))), (4, " ".join(prose(rng, 30)))]
    assert substring_dedup.removals(frame(spark, rows)).count() == 0


def test_repeats_of_odd_rows(spark):
    assert substring_dedup.removals(frame(spark, [])).count() == 0
    rng = random.Random(5)
    p = " ".join(prose(rng, 70))
    rows = [(1, p, 5, "m"), (2, f"a {p}\nb", 6, None), (2, f"a {p}\nb", 6, None), (None, p, 7, "x")]
    docs = frame(spark, rows, "doc_id long, text string, n_chars long, mark string")
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 4
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_bands_are_tuned():
    bands, rows = substring_dedup.tune_bands(0.8, 0.95)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.95 and rows > 1


def test_paragraphs_do_not_depend_on_what_stands_around():
    rng = random.Random(6)
    p, more = prose(rng, 50), prose(rng, 300)
    for before in range(0, 60, 7):
        text = " ".join([*prose(rng, before), *p, *prose(rng, 40)]).encode()
        found = substring_dedup.paragraphs([b"x y", text, b"", " ".join(more).encode()])
        assert any(t == 1 and before <= a <= before + 26 and n == 24 for t, a, n in zip(found.text, found.start, found.length, strict=True))
        alone = substring_dedup.paragraphs([text])
        own = found.text == 1
        assert sorted(zip(alone.start, alone.length, alone.content, strict=True)) == sorted(zip(found.start[own], found.length[own], found.content[own], strict=True))


def test_paragraphs_by_hand():
    """Places, contents and band keys against the plain definitions."""
    from tidemark.llm.common import mix, shingle_hashes, word_hashes

    rng = random.Random(9)
    texts = ["\n".join(" ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(6))).encode() for _ in range(40)] + [b"", b"a " * 300]
    p = substring_dedup.paragraphs(texts)
    near = len(p.text) - len(p.keys[0])
    by_words = {}
    for k, (t, a, n, c) in enumerate(zip(p.text, p.start, p.length, p.content, strict=True)):
        w = texts[t].split()[a : a + n]
        assert len(w) == n and by_words.setdefault(tuple(w), c) == c
        if k >= near:
            assert n >= 24
            s = shingle_hashes(word_hashes([b" ".join(w)])[0], 5)
            for band, keys in enumerate(p.keys):
                turn = mix(np.array([1 + band], np.uint64))[0] | np.uint64(1)
                x = s * turn
                assert mix(np.uint64(band + 1) + np.array([(x ^ (x >> np.uint64(29))).min()]))[0] == keys[k - near]
    assert len(set(by_words.values())) == len(by_words)
    lines = {(t, tuple(line.split())) for t, text in enumerate(texts) for line in text.split(b"\n") if 24 <= len(line.split()) <= 256}
    assert lines <= {(t, tuple(texts[t].split()[a : a + n])) for t, a, n in zip(p.text, p.start, p.length, strict=True)}


def passage_model(rows):
    """What goes and who keeps it: all pairs of line contents that meet in a band, for texts of one line each."""
    low, sets, bands, own = {}, {}, defaultdict(set), {}
    for i, t in rows:
        p = substring_dedup.paragraphs([t.encode()])
        near = len(p.text) - len(p.keys[0])
        k = next(k for k in range(near, len(p.text)) if p.length[k] == len(t.split()))
        c, w = int(p.content[k]), t.split()
        own[i] = c
        low[c], sets[c] = min(i, low.get(c, i)), {tuple(w[x : x + 5]) for x in range(len(w) - 4)}
        for b, keys in enumerate(p.keys):
            bands[b, int(keys[k - near])].add(c)
    root = {c: c for c in low}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for band in bands.values():
        for x in band:
            for y in band:
                if x < y and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    keep = {}
    for c, i in low.items():
        keep[find(c)] = min(i, keep.get(find(c), i))
    return {i: keep[find(c)] for i, c in own.items() if keep[find(c)] != i}


@pytest.mark.parametrize("block", [4096, 7])
def test_every_pair_that_meets_in_a_band_is_tried(spark, monkeypatch, block):
    """Many unlike paragraphs share a phrase, so they meet in bands where near copies don't stand next to each other."""
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    rng = random.Random(7)
    phrase, texts = prose(rng, 15), []
    for _ in range(150):
        base = [*prose(rng, 12), *phrase, *prose(rng, 12)]
        texts += [base, [*base[:-2], "edit", "more"]]
    texts += texts[:3]
    rows = list(enumerate(" ".join(t) for t in texts))
    want = passage_model(rows)
    assert len(want) > 100
    got = {r.doc_id: r.keep_id for r in substring_dedup.removals(frame(spark, rows)).collect()}
    assert got == want


def alike(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return 100 * len(x & y) >= 80 * len(x | y)


@pytest.mark.parametrize("lines, length, edits, least", [(True, 60, 1, 0.93), (False, 200, 2, 0.9)])
def test_recall_of_edited_passages(spark, lines, length, edits, least):
    """Passages that are alike by brute force: as lines, and anywhere in running text. What windows of 24 words find doesn't count:
    half of the passage must go."""
    rng = random.Random(8)
    part, rows, pairs = "\n" if lines else " ", [], 0
    for i in range(80):
        p = prose(rng, length)
        q = list(p)
        for k in range(edits):
            q[(2 * k + 1) * length // (2 * edits)] = f"edit{i}-{k}"
        assert alike(p, q)
        rows += [(2 * i + h, part.join([" ".join(prose(rng, 60)), " ".join(x), " ".join(prose(rng, 60))])) for h, x in enumerate((p, q))]
        pairs += 1
    gone = defaultdict(int)
    for r in substring_dedup.removals(frame(spark, rows)).collect():
        assert r.doc_id % 2 and r.keep_id == r.doc_id - 1
        gone[r.doc_id] += r.length
    assert sum(n > length / 2 for n in gone.values()) >= least * pairs


def test_bands_of_the_operator_find_nearly_all():
    assert 1 - (1 - 0.8**substring_dedup.ROWS) ** substring_dedup.BANDS >= 0.99
