"""The store of listings: which arrivals are new, changed, unchanged or duplicates of others."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.components import connected_components
from tidemark.operators.durable import durable

RESULT = "seq long, external_id string, url string, content_hash string, outcome string, stored_id string, duplicate_of string"


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("url", "external_id"), order: str = "seq") -> DataFrame:
    """The rows to add to a table with several unique keys: in order, those that share no key with the table or an added row.

    A row that loses on one key doesn't count against later ones on its other keys; those chains are rare and short, and each
    round settles the first row of every group of rows that share keys, so rounds end with the longest chain."""
    left = rows
    for k in keys:
        left = left.join(table.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_anti")
    added = None
    left = durable(left)
    while True:
        firsts = left
        for k in keys:
            firsts = firsts.withColumn(f"_{k}", F.min(order).over(Window.partitionBy(k)))
        now = firsts.where(" and ".join(f"_{k} = {order}" for k in keys)).select(*rows.columns)
        now = durable(now)
        added = now if added is None else added.unionByName(now)
        rest = left.join(now.select(order), order, "left_anti")
        for k in keys:
            rest = rest.join(now.select(k).distinct(), k, "left_anti")
        left = durable(rest.select(*rows.columns))
        if not left.limit(1).count():
            return added


def matching(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows with `stored_id` of the table's row of the same external_id, else of the same url: two equal joins in place of one with OR."""
    by_id = table.select(F.col("external_id"), F.col("external_id").alias("_by_id")).dropDuplicates(["external_id"])
    by_url = table.groupBy("url").agg(F.min("external_id").alias("_by_url"))
    return rows.join(by_id, "external_id", "left").join(by_url, "url", "left").withColumn("stored_id", F.coalesce("_by_id", "_by_url")).drop("_by_id", "_by_url")


def replay(rows: pd.DataFrame) -> pd.DataFrame:
    """The outcomes of arrivals whose keys meet, one after the other. Stored rows come first, with seq below 0."""
    by_id: dict = {}
    by_url: dict = {}
    by_hash: dict = {}
    listings: dict = {}
    out = []

    def put(owner, url, digest) -> None:
        old = listings.get(owner)
        if old:
            if by_url.get(old[0]) == owner:
                del by_url[old[0]]
            if old[1] is not None:
                by_hash[old[1]].pop(owner, None)
        listings[owner] = (url, digest)
        by_id[owner] = by_url[url] = owner
        if digest is not None:
            by_hash.setdefault(digest, {})[owner] = None

    for seq, key, url, digest in rows.sort_values("seq")[["seq", "external_id", "url", "content_hash"]].itertuples(index=False):
        digest = digest if isinstance(digest, str) else None
        if seq < 0:
            put(key, url, digest)
            continue
        owner = by_id.get(key, by_url.get(url))
        duplicate = None
        if owner is not None:
            if digest is not None and listings[owner][1] == digest:
                outcome = "unchanged"
            elif by_url.get(url, owner) != owner:
                outcome = "conflict"
            else:
                outcome = "updated"
                put(owner, url, digest)
        elif digest is not None and by_hash.get(digest):
            outcome, duplicate = "duplicate", next(iter(by_hash[digest]))
        else:
            outcome, owner = "inserted", key
            put(key, url, digest)
        out.append((seq, key, url, digest, outcome, owner, duplicate))
    return pd.DataFrame(out, columns=["seq", "external_id", "url", "content_hash", "outcome", "stored_id", "duplicate_of"])


def save_listings(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The outcome of each arrival (seq, external_id, url, content_hash) against the store and all earlier arrivals.

    `inserted`; `updated` or `unchanged` (an equal hash that isn't null) when the id, else the url, is stored; `duplicate` when only
    the hash is, with the id of the earliest row that holds it in duplicate_of; `conflict` when the id is one row's and the url another's.
    Null hashes never match. stored: rows of the same columns with any seq.

    Arrivals whose id and url stand once in all take the fast path: a window over each hash. The others, with all that their keys
    reach, are replayed in order for each component of rows that share an id, a url or (where a repeated row is among them) a hash.
    """
    arrivals = rows.select("seq", "external_id", "url", "content_hash")
    everything = arrivals
    if stored is not None:
        top = stored.agg(F.max("seq")).first()[0] or 0
        numbered = stored.select((F.col("seq") - F.lit(top) - 1).alias("seq"), "external_id", "url", "content_hash")
        everything = arrivals.unionByName(numbered)
    everything = durable(everything)
    links = None
    for k in ("external_id", "url", "content_hash"):
        own = everything.where(F.col(k).isNotNull()).select("seq", F.min("seq").over(Window.partitionBy(k)).alias("least"), F.count(F.lit(1)).over(Window.partitionBy(k)).alias("n"))
        own = own.where("n > 1").select(F.col("seq").alias("a"), F.col("least").alias("b"), F.lit(k != "content_hash").alias("hard"))
        links = own if links is None else links.unionByName(own)
    links = durable(links)
    # hash groups that touch no row with a repeated id or url, nor the store, need no replay
    parts = connected_components(links)
    touched = links.where("hard").select("a").unionByName(links.where("hard").select(F.col("b").alias("a"))).unionByName(everything.where("seq < 0").select(F.col("seq").alias("a"))).distinct()
    hard = parts.join(touched, F.col("node") == F.col("a"), "left_semi").select("component").distinct()
    placed = everything.join(parts.join(hard, "component", "left_semi"), F.col("seq") == F.col("node"), "left")
    placed = durable(placed.select("seq", "external_id", "url", "content_hash", "component"))
    simple = placed.where("component is null and seq >= 0")
    same = Window.partitionBy("content_hash").orderBy("seq")
    plain = simple.where("content_hash is not null").withColumn("first", F.first("external_id").over(same)).withColumn("nth", F.row_number().over(same))
    plain = plain.unionByName(simple.where("content_hash is null").withColumn("first", F.col("external_id")).withColumn("nth", F.lit(1)))
    first_seen = F.col("nth") == 1
    fast = plain.select(
        "seq", "external_id", "url", "content_hash", F.when(first_seen, "inserted").otherwise("duplicate").alias("outcome"),
        F.when(first_seen, F.col("external_id")).alias("stored_id"), F.when(~first_seen, F.col("first")).alias("duplicate_of"),
    )
    exact = placed.where("component is not null").groupBy("component").applyInPandas(lambda pdf: replay(pdf), RESULT)
    return fast.unionByName(exact)


def latest(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The last row of each key: what an upsert leaves."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_nth = 1").drop("_nth")


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key).distinct(), key, "left_anti")


def page_counters(found: DataFrame, added: DataFrame, page: str = "page", order: str = "seq") -> DataFrame:
    """Of each page: how many rows it listed and how many of them were new."""
    new = added.select(F.col(order).alias("_added")).distinct()
    return found.join(new, found[order] == new["_added"], "left").groupBy(page).agg(F.count(F.lit(1)).alias("found"), F.count("_added").alias("new"))
