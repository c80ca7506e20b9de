"""Counts of the queue and completeness of the listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY = ("total_listings", "with_price", "with_images", "with_description", "with_location", "duplicates", "failed")


def counts(state: DataFrame) -> DataFrame:
    """One row: urls by status; pending are discovered and processing ones, processed all that ended."""
    status = F.col("status")
    n = lambda *s: F.count_if(status.isin(*s))
    return state.agg(
        F.count(F.lit(1)).alias("discovered"), n("SUCCESS").alias("success"), n("FAILED").alias("failed"), n("SKIPPED").alias("skipped"),
        n("DISCOVERED", "PROCESSING").alias("pending"), n("SUCCESS", "FAILED", "SKIPPED").alias("processed"),
        F.count_if(F.col("error").like("duplicate_of:%")).alias("duplicates"),
    )


def filled(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def completeness(listings: DataFrame) -> DataFrame:
    """One row: listings, and how many have each part. A price counts with an amount, a location with any of its parts."""
    place = F.col("location")
    has = {
        "title": filled(F.col("title")), "price": F.col("price.amount").isNotNull(), "description": filled(F.col("description")),
        "images": F.size("images") > 0, "location": filled(place["wilaya"]) | filled(place["commune"]) | filled(place["raw"]),
        "seller": filled(F.col("seller.display_name")), "category": filled(F.col("category")), "published_at": filled(F.col("published_at")),
    }
    return listings.agg(F.count(F.lit(1)).alias("total_listings"), *[F.count_if(c).alias(f"with_{n}") for n, c in has.items()])


def quality_report(listings: DataFrame, state: DataFrame) -> DataFrame:
    """completeness beside duplicates, failed, pending and discovered of the queue: its single row of counts comes first."""
    row = counts(state).select("duplicates", "failed", "pending", "discovered").first().asDict()
    return completeness(listings).withColumns({name: F.lit(n).cast("bigint") for name, n in row.items()})


def summary(report: DataFrame) -> DataFrame:
    return report.select(*SUMMARY)
