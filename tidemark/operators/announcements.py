"""Announcement records of the API as listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binding import bound
from tidemark.functions.images import media_images
from tidemark.functions.price import CURRENCY, number_text
from tidemark.functions.text import none_if_empty
from tidemark.functions.urls import listing_url, normalize_url
from tidemark.functions.variants import is_blank, is_falsy, is_text, single
from tidemark.sources.schemas import ANNOUNCEMENT


def _filled(*parts: Column) -> Column:
    return none_if_empty(F.concat_ws(", ", *[none_if_empty(p) for p in parts]))


def _number(value: Column) -> Column:
    """A JSON number as a double; null for other types."""
    return F.when(~is_text(value), F.try_variant_get(value, "$", "double"))


def _shown(value: Column) -> Column:
    return F.coalesce(number_text(_number(value)), F.try_variant_get(value, "$", "string"))


def price_raw(r: Column) -> Column:
    """The price as the page shows it: the preview if there is one, and the unit; null if neither price nor preview says anything."""
    price, preview = r["price"], r["pricePreview"]
    none = lambda v: v.isNull() | F.coalesce(F.schema_of_variant(v) == "VOID", F.lit(True))
    silent = lambda v: none(v) | F.coalesce(_number(v) == 0, F.lit(False))
    shown = F.when(~none(preview), _shown(preview)).when(~none(price), _shown(price)).otherwise(F.lit("None"))
    unit = none_if_empty(r["priceUnit"])
    return F.when(~(silent(price) & silent(preview)), F.when(unit.isNotNull(), F.trim(F.concat(shown, F.lit(" "), unit))).otherwise(shown))


def attribute_entries(r: Column) -> Column:
    """Map entries of a record's attributes, later ones of a key outdoing earlier ones: the summary's (first of a key wins), then the specifications'."""
    empty = F.array().cast("array<struct<key:string,value:variant>>")
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    specs = F.transform(r["specs"], lambda s: entry(s["specification"]["codename"], F.when(is_falsy(s["valueText"]), s["value"]).otherwise(s["valueText"])))
    small = F.transform(r["smallDescription"], lambda s: entry(s["specification"]["codename"], s["valueText"]))
    usable = lambda e: e["key"].isNotNull() & (e["key"] != "") & ~is_blank(e["value"])
    specs = F.transform(F.filter(specs, usable), lambda e: entry(e["key"], single(e["value"])))
    return F.concat(F.coalesce(F.reverse(F.filter(small, usable)), empty), F.coalesce(specs, empty))


def attribute_labels(r: Column) -> Column:
    kept = F.filter(r["specs"], lambda s: s["specification"]["codename"].isNotNull() & (s["specification"]["codename"] != "") & ~is_blank(F.when(is_falsy(s["valueText"]), s["value"]).otherwise(s["valueText"])) & F.coalesce(s["specification"]["label"] != "", F.lit(False)))
    return F.map_from_entries(F.transform(kept, lambda s: F.struct(s["specification"]["codename"].alias("key"), s["specification"]["label"].alias("value"))))


def _full(items: Column) -> Column:
    """A list, null if it is empty."""
    return F.when(F.size(items) > 0, items)


def _compact(fields: dict[str, Column]) -> Column:
    """An object of the fields that aren't null; zeros and false stay."""
    return F.parse_json(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])))


def parse_announcements(payloads: DataFrame, base_url: str, scraped_at: str, source: str, api: str = "graphql") -> DataFrame:
    """Listings from a column `payload` of JSON records; other columns stay beside them.

    Two flags tell what can't become a listing: `rejected` is `missing_id` or `category_without_names`, else null. Summary and
    detail records are told apart by the key `specs`. All maps keep the last of a repeated key (session setting
    spark.sql.mapKeyDedupPolicy=LAST_WIN). Whole amounts count as whole numbers whether or not the JSON had a fraction.
    """
    rest = [F.col(c) for c in payloads.columns if c != "payload"]
    rows = bound(payloads.select(*rest, "payload"), r=F.from_json("payload", ANNOUNCEMENT))
    r = F.col("r")
    base = F.lit(base_url.rstrip("/"))
    category = r["category"]
    tree = F.filter(category["parentTree"], lambda t: t.isNotNull())
    names = F.filter(F.transform(tree, lambda t: t["name"]), lambda n: n.isNotNull() & (n != ""))
    leaf = none_if_empty(category["name"])
    path = F.concat(F.coalesce(names, F.array().cast("array<string>")), F.when(leaf.isNotNull(), F.array(leaf)).otherwise(F.array().cast("array<string>")))
    nested = F.coalesce(F.size(tree), F.lit(0)) > 0
    cities = F.filter(r["cities"], lambda c: c.isNotNull())
    first = F.get(cities, F.lit(0))
    commune, wilaya = first["name"], first["region"]["name"]
    amount = _number(r["price"])
    store, user = r["store"], r["user"]
    from_store = F.coalesce(r["isFromStore"], F.lit(False))
    has_store, has_user = from_store & F.coalesce(store["name"] != "", F.lit(False)), F.coalesce(user["displayName"] != "", F.lit(False))
    some = lambda v: F.when(~is_falsy(v), v)
    store_meta = F.when(store.isNotNull(), F.struct(
        *[none_if_empty(store[f]).alias(n) for n, f in (("id", "id"), ("slug", "slug"), ("url", "url"), ("description", "description"))],
        store["followerCount"].alias("followers"), store["announcementsCount"].alias("announcements_count"), none_if_empty(store["status"]).alias("status"),
        store["isOfficial"].alias("is_official"), store["isVerified"].alias("is_verified"),
        _full(F.transform(store["locations"], lambda x: x["location"]["address"])).alias("addresses"),
        _full(F.transform(store["categories"], lambda x: x["name"])).alias("categories"),
    ))
    city_list = F.transform(cities, lambda c: F.struct(none_if_empty(c["id"]).alias("id"), none_if_empty(c["name"]).alias("commune"), none_if_empty(c["region"]["name"]).alias("wilaya")))
    labels = attribute_labels(r)
    metadata = _compact({
        "api": F.lit(api), "reference": none_if_empty(r["reference"]), "slug": none_if_empty(r["slug"]), "refreshed_at": none_if_empty(r["refreshedAt"]),
        "status": none_if_empty(r["status"]), "price_type": none_if_empty(r["priceType"]), "price_preview": F.when(~is_blank(r["pricePreview"]), r["pricePreview"]),
        "old_price": some(r["oldPrice"]), "exchange_type": none_if_empty(r["exchangeType"]), "has_delivery": r["hasDelivery"], "delivery_type": none_if_empty(r["deliveryType"]),
        "quantity": r["quantity"], "street_name": none_if_empty(r["street_name"]), "has_phone": r["hasPhone"], "has_email": r["hasEmail"],
        "category_id": none_if_empty(category["id"]), "category_slug": none_if_empty(category["slug"]), "category_path": _full(path),
        "category_ids": _full(F.transform(r["categories"], lambda c: c["id"])), "cities": F.when(F.size(cities) > 1, city_list),
        "store": F.when(F.to_json(store_meta) != "{}", store_meta), "attribute_labels": F.when(F.size(labels) > 0, labels), "variants": some(r["variants"]),
        "is_detail_record": F.array_contains(F.json_object_keys("payload"), "specs"),
    })
    return rows.select(
        *rest,
        F.lit(source).alias("source"),
        r["id"].alias("external_id"),
        F.when(F.coalesce(r["slug"] != "", F.lit(False)), listing_url(base, r["slug"], r["id"])).otherwise(normalize_url(F.concat(base, F.lit("/annonce-d"), r["id"]))).alias("url"),
        r["title"].alias("title"),
        F.when(nested, F.get(path, F.lit(0))).otherwise(leaf).alias("category"),
        F.when(nested, leaf).alias("subcategory"),
        F.struct(amount.alias("amount"), F.when(amount > 0, F.lit(CURRENCY)).alias("currency"), price_raw(r).alias("raw"), r["priceUnit"].alias("unit")).alias("price"),
        F.struct(wilaya.alias("wilaya"), commune.alias("commune"), F.when(first.isNotNull(), _filled(r["street_name"], commune, wilaya)).alias("raw")).alias("location"),
        r["description"].alias("description"),
        r["createdAt"].alias("published_at"),
        F.struct(
            F.when(has_store, store["name"]).when(has_user, user["displayName"]).alias("display_name"),
            F.when(has_store, F.lit("store")).when(has_user, F.lit("individual")).when(from_store, F.lit("store")).alias("type"),
        ).alias("seller"),
        F.map_from_entries(attribute_entries(r)).alias("attributes"),
        media_images(r["medias"], r["defaultMedia"]).alias("images"),
        metadata.alias("source_metadata"),
        F.lit(scraped_at).alias("scraped_at"),
        F.when(r["id"].isNull(), "missing_id").when(nested & (F.size(path) == 0), "category_without_names").alias("rejected"),
    )
