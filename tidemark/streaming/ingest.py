"""Incremental ingestion of landed payloads with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.announcements import parse_announcements
from tidemark.operators.normalize import normalize_listings
from tidemark.sources.schemas import LISTING_COLUMNS


def payload_stream(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """New lines of JSON files in a folder: payload."""
    return spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder).select(F.col("value").alias("payload"))


def listing_stream(payloads: DataFrame, base_url: str, scraped_at: str, source: str) -> DataFrame:
    """Clean listings of a stream (or a table) of payloads; records that can't become one are left out."""
    parsed = parse_announcements(payloads, base_url, scraped_at, source).where("rejected is null").drop("rejected")
    return normalize_listings(parsed).select(*LISTING_COLUMNS)


def batch_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its own, so that a batch that runs again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def ingest(payloads: DataFrame, base_url: str, scraped_at: str, source: str, folder: str, checkpoint: str) -> StreamingQuery:
    """All payloads that have landed, as listings in folder/batch=N; the checkpoint makes the next call go on where this one ended."""
    rows = listing_stream(payloads, base_url, scraped_at, source)
    return rows.writeStream.foreachBatch(batch_writer(folder)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(rows: DataFrame, key: str = "external_id", at: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key of a stream. With an event time, keys are forgotten once the watermark passes them, which bounds the state."""
    return rows.dropDuplicates([key]) if at is None else rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Extension: counts and sums of events by type in event-time windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
