"""Lists of images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.text import clean_text, none_if_empty, strip
from tidemark.functions.urls import normalize_image_url

IMAGE = "struct<url:string,position:int,alt:string,width:int,height:int,source:string>"


def dimension(text: Column) -> Column:
    """Whole pixels above zero of texts such as `480` and `480px`."""
    return let(F.regexp_replace(strip(text), "[px]+$", "").try_cast("int"), lambda n: F.when(n > 0, n))


def is_image(mime: Column) -> Column:
    return mime.isNull() | (mime == "") | F.startswith(F.lower(mime), F.lit("image"))


def numbered(urls: Column) -> Column:
    """Images from urls: first of each, in order, counted from 0."""
    kept = F.array_distinct(F.filter(urls, lambda u: u.isNotNull()))
    return F.transform(kept, lambda u, i: F.struct(u.alias("url"), i.cast("int").alias("position"), F.lit(None).cast("string").alias("alt"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit("listing").alias("source")))


def media_images(medias: Column, default: Column) -> Column:
    """Images of a record's media: those that are images, or of unknown type; the default medium only if there is no other."""
    present = F.filter(medias, lambda m: m.isNotNull())
    fallback = F.when(default.isNotNull(), F.array(default)).otherwise(F.array().cast("array<struct<mediaUrl:string,mimeType:string,thumbnail:string>>"))
    chosen = F.when(F.coalesce(F.size(present), F.lit(0)) > 0, present).otherwise(fallback)
    return numbered(F.transform(F.filter(chosen, lambda m: is_image(m["mimeType"])), lambda m: normalize_image_url(m["mediaUrl"])))


def page_images(found: Column, base: Column) -> Column:
    """Images of a page from its candidates (url, alt, width, height): first of each canonical url, in order."""
    usable = F.filter(F.transform(found, lambda i: F.struct(normalize_image_url(i["url"], base).alias("url"), let(strip(i["alt"]), none_if_empty).alias("alt"), dimension(i["width"]).alias("width"), dimension(i["height"]).alias("height"))), lambda i: i["url"].isNotNull())
    return renumbered(F.transform(usable, lambda i: F.struct(i["url"].alias("url"), F.lit(0).alias("position"), i["alt"].alias("alt"), i["width"].alias("width"), i["height"].alias("height"), F.lit("listing").alias("source"))))


def renumbered(images: Column) -> Column:
    """The first image of each url, positions counted anew."""
    first = lambda xs, urls: F.filter(xs, lambda i, n: F.array_position(urls, i["url"]) == n + 1)
    kept = let(images, lambda xs: let(F.transform(xs, lambda i: i["url"]), lambda urls: first(xs, urls)))
    return F.transform(kept, lambda i, n: F.struct(i["url"].alias("url"), n.cast("int").alias("position"), i["alt"].alias("alt"), i["width"].alias("width"), i["height"].alias("height"), i["source"].alias("source")))


def cleaned_images(images: Column) -> Column:
    """renumbered, with tidy alternative texts."""
    return F.transform(renumbered(images), lambda i: F.struct(i["url"].alias("url"), i["position"].alias("position"), clean_text(i["alt"], normalise=False).alias("alt"), i["width"].alias("width"), i["height"].alias("height"), i["source"].alias("source")))
