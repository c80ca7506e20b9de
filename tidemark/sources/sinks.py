"""Exports of listings. Tables are written by the executors under Spark's commit protocol; one-file exports stream through the driver."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.landed import numeric_id
from tidemark.sources.schemas import LISTING_COLUMNS


def listings_in_order(listings: DataFrame) -> DataFrame:
    return listings.select(*LISTING_COLUMNS).orderBy(numeric_id(F.col("external_id")), "external_id")


def image_records(listings: DataFrame) -> DataFrame:
    """A row for each image, with the id and url of its listing; listings without images give none."""
    return listings.select("external_id", F.col("url").alias("listing_url"), F.inline("images"))


def json_rows(df: DataFrame) -> DataFrame:
    """Rows as compact JSON with nulls written out: column value."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def append_json_lines(df: DataFrame, folder: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(folder)


def write_json_lines(df: DataFrame, folder: str) -> None:
    """A folder of JSON lines files that together replace what was there. Sorted input stays in order across the files."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def write_file(spark: SparkSession, path: str, chunks: Iterable[str]) -> None:
    """One file in any store that Spark writes to: written beside its place, then renamed over it in one step, so a reader
    finds the old file or the new one at any time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(conf)
    target, beside = (fs.makeQualified(hadoop.Path(p)) for p in (path, f"{path}.tmp"))
    out = fs.create(beside, True)
    try:
        for chunk in chunks:
            out.write(bytearray(chunk.encode()))
    finally:
        out.close()
    kind = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, overwrite)


def write_json_array(df: DataFrame, path: str) -> None:
    """All rows in one JSON array, a line each. Rows stream through the driver one partition at a time; meant for small exports."""

    def chunks():
        yield "[\n"
        for n, row in enumerate(json_rows(df).toLocalIterator()):
            yield (",\n" if n else "") + row["value"]
        yield "\n]\n"

    write_file(df.sparkSession, path, chunks())


def write_report(row: DataFrame, path: str) -> dict:
    """A report's single row as an indented JSON object."""
    values = row.first().asDict()
    write_file(row.sparkSession, path, [json.dumps(values, indent=2) + "\n"])
    return values


def export_all(listings: DataFrame, report: DataFrame, folder: str, single_file: bool = True) -> dict:
    """listings.jsonl, images.jsonl (folders), listings.json, summary.json and data-quality.json; returns the summary. Without
    single_file, listings.json is left out: its rows stream through the driver, which suits small exports only."""
    from tidemark.operators.report import summary

    ordered = listings_in_order(listings)
    write_json_lines(ordered, f"{folder}/listings.jsonl")
    write_json_lines(image_records(ordered), f"{folder}/images.jsonl")
    if single_file:
        write_json_array(ordered, f"{folder}/listings.json")
    write_report(report, f"{folder}/data-quality.json")
    return write_report(summary(report), f"{folder}/summary.json")


def raw_payloads(records: DataFrame, folder: str, ingest_date: str) -> None:
    """Landed records (external_id, payload) kept as they came, by day."""
    records.withColumn("ingest_date", F.lit(ingest_date)).write.mode("append").partitionBy("ingest_date").parquet(folder)


def reset(spark: SparkSession, tables: dict[str, str]) -> None:
    """Tables (folder: schema) overwritten with nothing."""
    for folder, schema in tables.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)
