import random

from pyspark.sql import functions as F

from tidemark.operators import queue, report, store


def sequential(rows):
    """The store, one arrival after the other."""
    stored, out = [], []
    for seq, key, url, digest in rows:
        same_id = [r for r in stored if r["id"] == key]
        same_url = [r for r in stored if r["url"] == url]
        hit = (same_id or same_url or [None])[0]
        if hit:
            if digest is not None and hit["hash"] == digest:
                out.append((seq, "unchanged", None))
            elif any(r is not hit for r in same_url):
                out.append((seq, "conflict", None))
            else:
                hit["url"], hit["hash"] = url, digest
                hit["at"] = seq
                out.append((seq, "updated", None))
            continue
        twins = sorted((r["at"], r["id"]) for r in stored if digest is not None and r["hash"] == digest)
        if twins:
            out.append((seq, "duplicate", twins[0][1]))
        else:
            stored.append({"id": key, "url": url, "hash": digest, "at": seq})
            out.append((seq, "inserted", None))
    return out


SCHEMA = "seq long, external_id string, url string, content_hash string"


def test_store_against_a_sequential_model(spark):
    rng = random.Random(5)
    for keys in (3, 8, 60):
        rows = [(i, f"i{rng.randrange(keys)}", f"u{rng.randrange(keys)}", rng.choice([None, *[f"h{k}" for k in range(keys)]])) for i in range(60)]
        got = sorted((r.seq, r.outcome, r.duplicate_of) for r in store.save_listings(spark.createDataFrame(rows, SCHEMA)).collect())
        assert got == sequential(rows)


def test_store_fast_path_and_stored_rows(spark):
    stored = spark.createDataFrame([(1, "a", "ua", "h1"), (2, "b", "ub", None)], SCHEMA)
    rows = [(10, "a", "ua", "h1"), (11, "c", "ub", "h2"), (12, "d", "ud", "h1"), (13, "e", "ue", "h9"), (14, "f", "uf", "h9"), (15, "g", "ug", None), (16, "h", "uh", None)]
    got = {r.seq: (r.outcome, r.duplicate_of) for r in store.save_listings(spark.createDataFrame(rows, SCHEMA), stored).collect()}
    assert got == {10: ("unchanged", None), 11: ("updated", None), 12: ("duplicate", "a"), 13: ("inserted", None), 14: ("duplicate", "e"), 15: ("inserted", None), 16: ("inserted", None)}


def test_insert_if_absent_in_order(spark):
    table = spark.createDataFrame([("u0", "i0")], "url string, external_id string")
    rows = spark.createDataFrame([(1, "u1", "i0"), (2, "u1", "i1"), (3, "u1", "i2"), (4, "u2", "i1"), (5, "u3", "i2")], "seq long, url string, external_id string")
    assert sorted(r.seq for r in store.insert_if_absent(table, rows).collect()) == [2, 5]


def log(spark, *ops):
    rows = [(i, "u", "1", op, f"t{i}", args.get("error"), args.get("status"), args.get("counted"), args.get("hash")) for i, (op, args) in enumerate(ops)]
    return queue.queue_state(spark.createDataFrame(rows, queue.TRANSITION)).first()


def test_queue_transitions(spark):
    d, p = ("discovered", {}), ("processing", {})
    s = log(spark, d, p, ("failed", {"error": "HTTP 500", "status": 500}))
    assert (s.status, s.attempts, s.error, s.http_status, s.failed_at) == ("FAILED", 1, "HTTP 500", 500, "t2")
    s = log(spark, d, p, ("failed", {"error": "x", "status": 404}), ("requeue", {}))
    assert (s.status, s.attempts, s.error, s.http_status, s.failed_at) == ("DISCOVERED", 0, None, 404, None)
    s = log(spark, d, p, ("recover", {}))
    assert (s.status, s.attempts) == ("DISCOVERED", 1)
    s = log(spark, d, p, ("release", {}), p, ("release", {"counted": True, "error": "e"}))
    assert (s.status, s.attempts, s.error) == ("DISCOVERED", 1, "e")
    s = log(spark, d, p, ("saved", {"status": 200, "hash": "h"}), ("recover", {}), d)
    assert (s.status, s.content_hash, s.processed_at, s.last_success_at) == ("SUCCESS", "h", "t2", "t2")
    assert log(spark, p) is None


def test_counts_and_sizes(spark):
    rows = [("DISCOVERED", None), ("PROCESSING", None), ("SUCCESS", None), ("SKIPPED", "duplicate_of:3"), ("FAILED", "duplicateXof:3")]
    c = report.counts(spark.createDataFrame(rows, "status string, error string")).first()
    assert (c.discovered, c.pending, c.processed, c.success, c.skipped, c.failed, c.duplicates) == (5, 2, 3, 1, 1, 1, 2)
    assert [queue.batch_size(n) for n in (0, 5, 900)] == [1, 5, 200]


def test_categories(spark):
    slugs = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "slug string, pos int")
    state = queue.mark_done(slugs, 1).unionByName(queue.reopen(slugs.where("slug = 'b'"), 2))
    row = queue.resume_point(queue.category_progress(state, slugs)).first()
    assert (row.done, row.categories, row.next_category, row.next_page) == (2, 3, "b", 1)
    assert queue.category_progress(state, slugs).where(F.col("done")).count() == 2
