"""Landed payload files and tables as DataFrames. Nothing is fetched: payloads arrive as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.urls import listing_url
from tidemark.functions.variants import is_falsy
from tidemark.sources.schemas import CHILDREN, FETCH_LOG, MENU, SEARCH_PAGE


def payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as rows: file, payload."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("payload"))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document a line: payload."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.col("value").alias("payload"))


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FETCH_LOG).json(path)


def table(df: DataFrame, name: str) -> DataFrame:
    """df under a name for SQL."""
    df.createOrReplaceTempView(name)
    return df


def menu_categories(menus: DataFrame) -> DataFrame:
    """Top categories of landed menus (column payload): slug and pos, first occurrences, entries without a slug left out."""
    items = menus.select(F.posexplode(F.from_json("payload", MENU)["listingMenu"]).alias("pos", "item"))
    return first_of(items.select("pos", F.col("item.target.slug").alias("slug")))


def child_categories(top: DataFrame, answers: DataFrame) -> DataFrame:
    """The children of each top category (answers: slug, payload), the category itself where it has none; first occurrences."""
    found = answers.select(F.col("slug").alias("parent"), F.posexplode(F.from_json("payload", CHILDREN)["search"]["active"]["category"]["children"]).alias("at", "child"))
    found = found.select("parent", "at", F.col("child.slug").alias("child")).where("child is not null and child <> ''")
    joined = top.join(found, top["slug"] == found["parent"], "left")
    rows = joined.select((F.col("pos").cast("long") * F.lit(1 << 31) + F.coalesce("at", F.lit(0))).alias("pos"), F.coalesce("child", "slug").alias("slug"))
    return first_of(rows)


def first_of(rows: DataFrame) -> DataFrame:
    """Each filled slug once, where it stands first."""
    return rows.where("slug is not null and slug <> ''").groupBy("slug").agg(F.min("pos").alias("pos"))


def explicit_categories(spark: SparkSession, slugs: list[str]) -> DataFrame:
    return spark.createDataFrame([(s, i) for i, s in enumerate(dict.fromkeys(slugs))], "slug string, pos int")


def search_pages(payloads: DataFrame) -> DataFrame:
    """Landed search answers (payload beside other columns): nodes with an id as an array of VARIANT, has_more, last_page, total."""
    rest = [F.col(c) for c in payloads.columns if c != "payload"]
    block = F.from_json("payload", SEARCH_PAGE)["search"]["announcements"]
    nodes = F.filter(F.coalesce(block["data"], F.array().cast("array<variant>")), lambda n: _has(n, "$.id"))
    info = block["paginatorInfo"]
    rows = payloads.select(*rest, nodes.alias("nodes"), info["lastPage"].alias("last_page"), info["total"].alias("total"), F.coalesce(info["hasMorePages"], F.lit(False)).alias("more"))
    return rows.select(*rest, "nodes", (F.col("more") & (F.size("nodes") > 0)).alias("has_more"), "last_page", "total")


def _has(node: Column, path: str) -> Column:
    return ~is_falsy(F.try_variant_get(node, path, "variant"))


def discovered(pages: DataFrame, base_url: str, order: str = "page") -> DataFrame:
    """Listings of search pages: external_id, url, summary (JSON) and seq; the first node of each id that has a slug."""
    nodes = pages.select(order, F.posexplode("nodes").alias("at", "node"))
    rows = nodes.where(_has(F.col("node"), "$.id") & _has(F.col("node"), "$.slug")).select(
        F.try_variant_get("node", "$.id", "string").alias("external_id"), F.try_variant_get("node", "$.slug", "string").alias("slug"),
        F.to_json("node").alias("summary"), (F.col(order).cast("long") * F.lit(1 << 31) + F.col("at")).alias("seq"),
    )
    first = rows.groupBy("external_id").agg(F.min_by("slug", "seq").alias("slug"), F.min_by("summary", "seq").alias("summary"), F.min("seq").alias("seq"))
    return first.select("external_id", listing_url(F.lit(base_url), F.col("slug"), F.col("external_id")).alias("url"), "summary", "seq")


def found_records(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detail answers (url, payload of the whole answer) as records (url, payload) and, for those without one, failures (url, error, http_status)."""
    node = F.try_variant_get(F.try_parse_json("payload"), "$.announcement", "variant")
    rows = answers.withColumn("node", node).withColumn("there", F.coalesce(~F.schema_of_variant("node").isin("VOID", "OBJECT<>"), F.lit(False)))
    records = rows.where("there").select("url", F.to_json("node").alias("payload"))
    missing = rows.where("not there").select("url", F.lit("not_found: listing no longer public").alias("error"), F.lit(200).alias("http_status"))
    return records, missing


def numeric_id(external_id: Column) -> Column:
    """The whole number that an id starts with, 0 without one."""
    return F.coalesce(F.regexp_extract(external_id, r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0))


def event_lines(lines: DataFrame) -> DataFrame:
    """Log lines (column value) of the form `event=... url=... status=... error='...'` as columns."""
    pick = lambda p: F.nullif(F.regexp_extract("value", p, 1), F.lit(""))
    return lines.where(F.col("value").contains("event=")).select(
        pick(r"\bevent=(\S+)").alias("event"), pick(r"\burl=(\S+)").alias("url"), pick(r"\bstatus=(\d+)").try_cast("int").alias("status"), pick(r"""\berror=['"](.*?)['"](?= \w+=|$)""").alias("error")
    )
