"""Clean listings, with their content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import normalize_datetime
from tidemark.functions.hashing import content_hash
from tidemark.functions.images import IMAGE, cleaned_images
from tidemark.functions.price import number_text, parse_price
from tidemark.functions.text import clean_text, nfc, none_if_empty
from tidemark.functions.variants import clean_value
from tidemark.sources.schemas import LISTING_COLUMNS


def with_resolved_price(listings: DataFrame) -> DataFrame:
    """The price with an amount above zero, read from the raw text if the record has none; without amount neither currency nor unit."""
    price = F.col("price")
    stated = F.when(price["amount"] > 0, price["amount"])
    rows = listings.withColumns({"_raw": clean_text(price["raw"]), "_currency": clean_text(price["currency"]), "_stated": stated})
    rows = rows.withColumn("_read", parse_price(F.when(F.col("_stated").isNull(), F.col("_raw"))))
    read, use = F.col("_read"), F.col("_stated").isNull() & F.col("_raw").isNotNull()
    rows = rows.withColumn("_amount", F.coalesce("_stated", F.when(read["amount"] > 0, read["amount"])))
    known = F.col("_amount").isNotNull()
    resolved = F.struct(
        F.col("_amount").alias("amount"),
        F.when(known, F.when(use, F.coalesce(read["currency"], "_currency")).otherwise(F.col("_currency"))).alias("currency"),
        F.col("_raw").alias("raw"),
        F.when(known, F.when(use, F.coalesce(none_if_empty(price["unit"]), read["unit"])).otherwise(price["unit"])).alias("unit"),
    )
    return rows.withColumn("price", resolved).drop("_raw", "_currency", "_stated", "_read", "_amount")


def cleaned_attributes(attributes: Column) -> Column:
    """Attributes with clean keys and values, without those that nothing is left of; the last of a key wins."""
    entries = F.transform(F.map_entries(attributes), lambda e: F.struct(clean_text(e["key"], normalise=False).alias("key"), clean_value(e["value"]).alias("value")))
    return F.to_variant_object(F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())))


def hash_payload(title: Column, description: Column, category: Column, subcategory: Column, price: Column, location: Column, seller: Column, attributes: Column) -> Column:
    """What makes two listings the same, fields in alphabetical order: neither ids nor times, images, currency or raw price."""
    amount = F.parse_json(F.coalesce(number_text(price["amount"]), F.lit("null")))
    unit = F.coalesce(price["unit"].cast("variant"), F.parse_json(F.lit("null")))
    return F.struct(
        attributes.alias("attributes"), category.alias("category"), description.alias("description"),
        F.array(location["wilaya"], location["commune"]).alias("location"), F.array(amount, unit).alias("price"),
        seller["display_name"].alias("seller"), subcategory.alias("subcategory"), title.alias("title"),
    )


def normalize_listings(listings: DataFrame) -> DataFrame:
    """Listings as they are stored: clean texts, whole-second UTC times, resolved prices, filled locations, unique images and the
    content hash (null without title and description). Columns that no listing has stay as they are."""
    # NFC runs on plain columns only, so nested strings go through their JSON, whose quotes no composition crosses
    nested = {"attributes": "map<string,variant>", "images": f"array<{IMAGE}>"}
    composed = listings.withColumns({c: F.from_json(nfc(F.to_json(c)), kind) for c, kind in nested.items()})
    steps = composed.withColumns(
        {
            "title": clean_text(F.col("title")),
            "category": clean_text(F.col("category")),
            "subcategory": clean_text(F.col("subcategory")),
            "description": clean_text(F.col("description"), keep_newlines=True),
            "published_at": normalize_datetime(F.col("published_at")),
            "location": F.struct(*[clean_text(F.col("location")[f]).alias(f) for f in ("wilaya", "commune", "raw")]),
            "seller": F.struct(clean_text(F.col("seller.display_name")).alias("display_name"), F.col("seller.type").alias("type")),
            "attributes": cleaned_attributes(F.col("attributes")),
            "images": cleaned_images(F.coalesce("images", F.array().cast(f"array<{IMAGE}>"))),
        }
    )
    steps = with_resolved_price(steps)
    place = F.col("location")
    filled = F.coalesce(place["raw"], none_if_empty(F.concat_ws(", ", place["commune"], place["wilaya"])))
    steps = steps.withColumn("location", F.struct(place["wilaya"].alias("wilaya"), place["commune"].alias("commune"), filled.alias("raw")))
    payload = hash_payload(*[F.col(c) for c in ("title", "description", "category", "subcategory", "price", "location", "seller", "attributes")])
    has_content = F.col("title").isNotNull() | F.col("description").isNotNull()
    steps = steps.withColumn("content_hash", F.when(has_content, content_hash(payload)))
    others = [c for c in steps.columns if c not in LISTING_COLUMNS]
    return steps.select(*LISTING_COLUMNS, *others)
