"""Canonical URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.text import none_if_empty, strip

# The query keys that only track visitors.
TRACKING_PREFIX = "utm_"
TRACKING_KEYS = ("fbclid", "gclid", "msclkid", "agent", "agent_force", "lang")

#: The generic URI syntax, as its standard gives it: scheme 2, authority 4, path 5, query 7.
URI = r"(?s)^(([a-zA-Z][a-zA-Z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URI, group)


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encoded(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical_query(query: Column) -> Column:
    """The query's pairs, blank values included, without tracking keys, sorted and encoded anew."""
    pieces = F.filter(F.split(query, "&", -1), lambda p: p != "")
    pairs = F.transform(pieces, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(p.contains("="), F.regexp_replace(p, "(?s)^[^=]*=", "")).otherwise(F.lit(""))).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING_KEYS) & ~F.startswith(F.lower(p["k"]), F.lit(TRACKING_PREFIX)))
    return F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def normalize_url(url: Column) -> Column:
    """The form that pages are told apart by: https, lower-case host, single slashes, no trailing slash, sorted query, no fragment."""
    url = strip(url)
    scheme = F.lower(part(url, 2))
    scheme = F.when(scheme.isin("", "http", "https"), F.lit("https")).otherwise(scheme)
    host, query = F.lower(part(url, 4)), canonical_query(part(url, 7))
    path = F.regexp_replace(F.regexp_replace(part(url, 5), "/{2,}", "/"), "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    start = F.when((host != "") | F.startswith(path, F.lit("/")), F.concat(scheme, F.lit("://"), host)).otherwise(F.concat(scheme, F.lit(":")))
    return F.concat(start, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def listing_url(base: Column, slug: Column, external_id: Column) -> Column:
    return normalize_url(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), slug, F.lit("-d"), external_id))


def extract_external_id(url: Column) -> Column:
    """The number behind the first `-d` that ends a part of the path."""
    return none_if_empty(F.regexp_extract(F.concat(part(url, 5), F.lit("/")), r"-d(\d+)/", 1))


def normalize_image_url(url: Column, base: Column | None = None) -> Column:
    """An absolute https URL without fragment; null for blank, data: and hostless ones. Paths from the root and of no scheme are
    joined to the base; `..` is left to the HTML reader."""

    def joined(url: Column) -> Column:
        if base is None:
            return url
        site = F.concat(part(base, 1), part(base, 3))
        folder = F.regexp_extract(part(base, 5), "^(.*/)", 1)
        rooted = F.when(F.startswith(url, F.lit("/")), F.concat(site, url)).otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), url))
        relative = ~url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") & ~F.startswith(url, F.lit("//"))
        return F.when(relative, rooted).otherwise(url)

    schemed = lambda url: F.when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url)).otherwise(url)
    # group 6 is the query with its question mark
    canonical = lambda url: F.when(url.rlike("^(?i:https?)://[^/?#]"), F.concat(F.lit("https://"), F.lower(part(url, 4)), part(url, 5), F.regexp_replace(part(url, 6), r"^\?\z", "")))
    found = let(strip(url), none_if_empty)
    for step in (joined, schemed, canonical):  # each bound once: written out, every step would hold the one before it several times
        found = let(found, step)
    return found


def image_file(url: Column, position: Column) -> Column:
    """The file name that an image of a listing gets: its place in two digits, and the suffix if it is a known one."""
    suffix = F.lower(F.regexp_extract(part(url, 5), r"(\.[^./]*)$", 1))
    number = F.when(position < 100, F.lpad(position.cast("string"), 2, "0")).otherwise(position.cast("string"))
    return F.concat(number, F.when(suffix.isin(".jpg", ".jpeg", ".png", ".webp", ".gif"), suffix).otherwise(F.lit(".jpg")))
