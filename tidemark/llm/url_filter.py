"""URL rules by a sort-merge range join, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def url_host(url: Column) -> Column:
    """From the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host to `?`, `#` or the end; empty without `://` or url."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels of a host reversed, each closed by a dot: a host and its subdomains are the keys that start with its key."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = spark.range(1).select(F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("host", "path", "verdict"), r, strict=True)]) for r in rules])).alias("r"))
    return rows.select("r.*")


def boundaries(rules: DataFrame) -> DataFrame:
    """The points of the sorted key line at which the stack of active rules changes, with the stack from there on.

    A rule's host covers the keys from its own up to the same with the last dot raised to the next byte, `/`, which no
    host holds. Such intervals nest or are apart: opening one pushes its rules on the stack, closing it pops them. The
    stack at an opening is the rules of the host and of those hosts that its key starts with, found by an equal join
    over the key's label prefixes.
    """
    listed = rules.select(host_key(F.col("host")).alias("key"), F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"), F.col("verdict"), F.concat("host", "path").alias("rule"), F.col("path")).alias("item"))
    hosts = listed.groupBy("key").agg(F.collect_set("item").alias("own"))
    labels = F.split("key", r"\.", -1)
    starts = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    above = hosts.select("key", F.explode(starts).alias("upper")).join(hosts.select(F.col("key").alias("upper"), "own"), "upper")
    stacks = above.groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack"), F.flatten(F.collect_list(F.when(F.col("upper") != F.col("key"), F.col("own")))).alias("below"))
    top = F.substring_index("key", ".", 1)
    opened = stacks.select(top.alias("top"), "key", "stack")
    closed = stacks.select(top.alias("top"), F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")).alias("key"), F.col("below").alias("stack"))
    return opened.unionByName(closed)


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int = 32) -> DataFrame:
    """The longest fitting rule of each page's url and its verdict; `default` where none fits.

    Urls and boundaries are merged in the order of their keys; a sweep carries the last boundary's stack to each url,
    which then takes the longest rule whose path starts its own (of equal length the longer host's, then `block`). No
    interval leaves the keys of one top label, so labels are swept apart from each other, and the urls of one label,
    which may be most of the web, are dealt over `salts` sweeps, each with its own copy of that label's boundaries.

    Returns page_id, host, path, rule (host and path of the rule, else null), verdict. Null url or no `://`: host and path
    are empty and no rule fits. Repeated or null page_ids: one answer for every row. Only page_id and url are read.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host"))).withColumn("top", F.substring_index("key", ".", 1))
    urls = urls.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)))
    edges = boundaries(rules).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    line = urls.withColumn("is_url", F.lit(1)).unionByName(edges.withColumn("is_url", F.lit(0)), allowMissingColumns=True)
    sweep = Window.partitionBy("top", "salt").orderBy("key", "is_url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = line.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("is_url = 1")
    best = F.array_max(F.filter("active", lambda r: F.startswith(F.col("path"), r["path"])))
    return swept.withColumn("best", best).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
