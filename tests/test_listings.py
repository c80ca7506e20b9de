import json
import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tidemark.functions.images import page_images
from tidemark.functions.variants import is_falsy
from tidemark.operators.announcements import parse_announcements
from tidemark.operators.normalize import normalize_listings
from tidemark.operators.pages import Page, absolute, parse_pages, read_page

BASE, AT = "https://shop.example.com/", "2026-01-01T00:00:00Z"

RICH = {
    "id": 71, "slug": "red-bike", "title": "Red  bike", "description": "Good.\n\n\n\nAs new", "createdAt": "2026-04-14T10:00:00.5+01:00", "price": 18500, "pricePreview": 18500, "priceUnit": "UNIT",
    "category": {"id": "9", "slug": "bikes", "name": "Bikes", "parentTree": [{"name": "Sports"}, None, {"name": "Cycling"}]},
    "specs": [
        {"specification": {"codename": "size", "label": "Size"}, "valueText": ["M"]}, {"specification": {"codename": "color"}, "valueText": "", "value": "red "},
        {"specification": {"codename": "none"}, "valueText": None, "value": []}, {"specification": {"codename": "size", "label": "Size"}, "valueText": ["L"]},
    ],
    "smallDescription": [{"specification": {"codename": "size"}, "valueText": "XS"}, {"specification": {"codename": "year"}, "valueText": "2020"}, {"specification": {"codename": "year"}, "valueText": "2021"}],
    "medias": [{"mediaUrl": "//i.e.com/1.jpg", "mimeType": "image/jpeg"}, {"mediaUrl": "https://i.e.com/v.mp4", "mimeType": "video/mp4"}, {"mediaUrl": "http://i.e.com/1.jpg"}, {"mediaUrl": "https://i.e.com/2.jpg", "mimeType": None}],
    "isFromStore": True, "store": {"id": "5", "name": "Shop", "followerCount": 0, "isVerified": False, "locations": [{"location": {"address": "1 Main St"}}]}, "user": {"displayName": "U"},
    "cities": [{"id": "1", "name": "Town", "region": {"name": "Land"}}, {"id": "2", "name": "Ville"}], "street_name": "Main", "quantity": 0, "variants": [],
}
BARE = {"id": "72", "price": None, "pricePreview": 0, "priceUnit": "UNIT", "category": {"name": "Odd", "parentTree": []}, "defaultMedia": {"mediaUrl": "https://i.e.com/d.png"}, "user": None}
TEXT = {"id": "73", "slug": "x", "title": "é", "price": "ask", "pricePreview": 1.8, "priceUnit": "BILLION", "specs": None}


def listings(spark, *records):
    return parse_announcements(spark.createDataFrame([(json.dumps(r),) for r in records], "payload string"), BASE, AT, "shop")


def by_id(df):
    return {r.external_id: r for r in df.withColumn("a", F.to_json("attributes")).withColumn("m", F.to_json("source_metadata")).collect()}


def test_records(spark):
    found = by_id(listings(spark, RICH, BARE, TEXT, {"title": "no id"}, {"id": "74", "category": {"parentTree": [{"slug": "s"}]}}))
    r = found["71"]
    assert r.url == "https://shop.example.com/red-bike-d71"
    assert (r.category, r.subcategory) == ("Sports", "Bikes")
    assert (r.price.amount, r.price.currency, r.price.raw, r.price.unit) == (18500.0, "DZD", "18500 UNIT", "UNIT")
    assert (r.location.wilaya, r.location.commune, r.location.raw) == ("Land", "Town", "Main, Town, Land")
    assert json.loads(r.a) == {"size": "L", "color": "red ", "year": "2020"}
    assert [(i.url, i.position) for i in r.images] == [("https://i.e.com/1.jpg", 0), ("https://i.e.com/2.jpg", 1)]
    assert (r.seller.display_name, r.seller.type) == ("Shop", "store")
    m = json.loads(r.m)
    assert m["is_detail_record"] is True and m["quantity"] == 0 and m["category_path"] == ["Sports", "Cycling", "Bikes"]
    assert m["store"] == {"id": "5", "followers": 0, "is_verified": False, "addresses": ["1 Main St"]}
    assert m["cities"] == [{"id": "1", "commune": "Town", "wilaya": "Land"}, {"id": "2", "commune": "Ville"}]
    assert m["attribute_labels"] == {"size": "Size"} and "variants" not in m
    b = found["72"]
    assert b.url == "https://shop.example.com/annonce-d72" and (b.category, b.subcategory) == ("Odd", None)
    assert (b.price.amount, b.price.raw, b.price.unit) == (None, None, "UNIT") and b.location.raw is None
    assert [i.url for i in b.images] == ["https://i.e.com/d.png"] and b.seller.type is None and json.loads(b.m)["is_detail_record"] is False
    assert (found["73"].price.amount, found["73"].price.raw) == (None, "1.8 BILLION")
    assert found[None].rejected == "missing_id" and found["74"].rejected == "category_without_names"


def test_normalised(spark):
    found = by_id(normalize_listings(listings(spark, RICH, BARE, TEXT)))
    r = found["71"]
    assert (r.title, r.description, r.published_at) == ("Red bike", "Good.\n\nAs new", "2026-04-14T09:00:00Z")
    assert json.loads(r.a)["color"] == "red" and len(r.content_hash) == 64
    assert found["72"].content_hash is None and found["72"].price.unit is None
    t = found["73"]
    assert t.title == "é" and (t.price.amount, t.price.unit) == (18000000.0, "BILLION")


def test_hash_ignores_ids_and_times(spark):
    other = RICH | {"id": "99", "slug": "s", "createdAt": None, "medias": None}
    changed = RICH | {"id": "98", "title": "Blue bike"}
    found = by_id(normalize_listings(listings(spark, RICH, other, changed)))
    assert found["71"].content_hash == found["99"].content_hash != found["98"].content_hash


LD = """<html><head><link rel="canonical" href="https://shop.example.com/lamp-d5"><script type="application/ld+json">
{"@graph": [{"@type": "WebPage"}, {"@type": ["Product"], "name": "Lamp", "image": ["//i.e.com/l.jpg", {"url": "https://i.e.com/m.jpg"}], "offers": [{"price": 45, "priceCurrency": "DZD", "seller": {"name": "Z"}}]}]}</script>
<script type="application/ld+json">{broken</script></head><body><h1>Other</h1></body></html>"""
PLAIN = """<meta property="og:title" content="OG"><meta property="og:image" content="/og.png"><link rel="canonical" href="https://shop.example.com/sofa-d6?utm_x=1">
<h1>Sofa <b>big</b></h1><p class="price">1 200 DA</p><div class="my-description">Soft</div><time datetime="2026-04-14T10:00:00+01:00">x</time>
<img src="data:image/png;base64,x"><img data-src="../a.png" alt=" A " width="480px"><img src="/og.png">"""
EMBEDDED = '<script>window.__STATE__ = {"x": [{"id": "8", "title": "In", "slug": "in", "price": 3}]};</script>'


def test_pages(spark):
    pages = [("https://shop.example.com/x-d1", LD), ("https://shop.example.com/sofa-d6", PLAIN), ("https://shop.example.com/app", "<div id=app></div>"), ("https://shop.example.com/e", EMBEDDED), ("https://shop.example.com/n-d9", None)]
    got = {r.external_id: r for r in normalize_listings(parse_pages(spark.createDataFrame(pages, "page_url string, html string"), BASE, AT, "shop")).collect()}
    assert set(got) == {"5", "6", "8", "9"}
    assert (got["5"].title, got["5"].price.amount, got["5"].price.currency, got["5"].seller.display_name) == ("Lamp", 45.0, "DZD", "Z")
    assert [i.url for i in got["5"].images] == ["https://i.e.com/l.jpg", "https://i.e.com/m.jpg"]
    s = got["6"]
    assert (s.title, s.price.amount, s.description, s.published_at, s.url) == ("Sofa big", 1200.0, "Soft", "2026-04-14T09:00:00Z", "https://shop.example.com/sofa-d6")
    assert [(i.url, i.alt, i.width) for i in s.images] == [("https://shop.example.com/og.png", None, None), ("https://shop.example.com/a.png", "A", 480)]
    assert (got["8"].title, got["8"].url) == ("In", "https://shop.example.com/in-d8")


def test_image_steps_are_bound_once(spark):
    """Written out, each step held the one before it several times: 162 s for 120,000 pages of four images."""
    found = [("/a.png", " A ", "1px"), ("https://S.com/a.png?#x", None, "0"), ("//s.com/a.png", "b", None), (" HTTP://s.com/a.png?q#y", "", "7"), ("data:x", None, None), ("a/b.png", None, None), ("http://", None, None), (None, None, None), ("/a.png", "again", "2")]
    rows = spark.createDataFrame([(found,)], "found array<struct<url:string,alt:string,width:string>>").selectExpr("transform(found, x -> struct(x.url, x.alt, x.width, x.width as height)) as found")
    images = rows.select(page_images(F.col("found"), F.lit("https://s.com/x/y")).alias("images"))
    assert [(i.url, i.position, i.alt, i.width) for i in images.first().images] == [
        ("https://s.com/a.png", 0, "A", 1), ("https://s.com/a.png?q", 1, None, 7), ("https://s.com/x/a/b.png", 2, None, None),
    ]
    assert images._jdf.queryExecution().optimizedPlan().toString().lower().count("regexp") < 40


def test_pages_are_read_once(spark):
    """A filter on what was found, and the two kinds of listings, had each page read up to four times."""
    rows = spark.createDataFrame([("https://s.com/x-d1", PLAIN), ("https://s.com/e", EMBEDDED), ("https://s.com/none", "")], "page_url string, html string")
    found = parse_pages(rows, BASE, AT, "shop").select("external_id", F.inline("images"))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.external_id for r in found.collect()} == {"6"}
    bad = [{"id": "9", "title": "t", "slug": "s", "category": {"parentTree": [{"slug": "x"}]}}, {"id": None, "title": "t", "slug": "s"}]
    pages = spark.createDataFrame([("https://s.com/x-d1", f'<script type="application/json">{json.dumps(b)}</script>') for b in bad], "page_url string, html string")
    assert parse_pages(pages, BASE, AT, "shop").count() == 0


def test_selectors_are_compiled_once_and_look_where_they_can_match(monkeypatch):
    """Each page compiled every selector anew and held it against every element."""
    seen, whole = [], re.fullmatch
    monkeypatch.setattr(re, "fullmatch", lambda *a: seen.append(a) or whole(*a))
    first = read_page(PLAIN, BASE)
    seen.clear()
    assert read_page(PLAIN, BASE) == first and first["price_raw"] == "1 200 DA" and not seen
    page = Page('<div class="price" itemprop=seller><i itemprop="name">A</i></div><i itemprop=name>B</i><p class="x price">C</p><p class="old-price">D</p><time>no</time><time datetime=E>')
    found = {s: [e.text() or e.attrs.get("datetime") for e in page.select(s)] for s in (".price", "[class*=price]", "[itemprop=seller] [itemprop=name]", "time[datetime]", "p", "h1")}
    assert found == {".price": ["A", "C"], "[class*=price]": ["A", "C", "D"], "[itemprop=seller] [itemprop=name]": ["A"], "time[datetime]": ["E"], "p": ["C", "D"], "h1": []}


def test_page_addresses_are_bound_once(spark):
    """The filter on a page's id held the steps of its address once more."""
    rows = spark.createDataFrame([("https://s.com/x-d1", PLAIN)], "page_url string, html string")
    found = parse_pages(rows, BASE, AT, "shop").select("external_id", "url")
    (kept,) = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.strip(" +-").startswith("Filter")]
    assert "_id#" in kept and "regexp" not in kept
    assert found.first() == ("6", "https://shop.example.com/sofa-d6")


def test_plain_paths_are_joined_like_the_others(monkeypatch):
    """The library's join, which took longer than the parsing of a small page, is left to addresses with something to resolve."""
    urls = ["/a", "/a/b-c_d.png", "/a.b/~c", "/a%20b", "/a/", "/", "//h.com/x", "/a//b", "/./a", "/a/../b", "/.a", "/a/..", "/a b", "/a;p", "/a?q", "/a?", "/a#f", "/a#", "a.png", "?q", "http://h.com/../a", "mailto:x", "/é", " /a ", "/a\t/b", "/a:b"]
    for base in ("https://s.com", "HTTP://S.com:80/x/y?q#f", "https://u@s.com/", "file:///x/y", "s.com/x", "//s.com/x", ""):
        assert [absolute(base, u) for u in urls] == [urljoin(base, u.strip()) for u in urls]
    assert [absolute("https://s.com", u) for u in (None, "", "data:x", " data:x")] == [None, "", "data:x", " data:x"]
    monkeypatch.setattr("tidemark.operators.pages.urljoin", None)
    assert absolute("https://s.com/x", " /a/b.png") == "https://s.com/a/b.png"


def test_selectors_without_candidates_are_not_tried(monkeypatch):
    """A page that nothing but classes describes had some twenty selectors tried on no element at all."""
    tried, select = [], Page.select
    monkeypatch.setattr(Page, "select", lambda self, s: tried.append(s) or select(self, s))
    found = read_page('<p class="price">12 <b>DA</b></p><div class="x my-description-y">soft</div>', BASE)
    assert (found["price_raw"], found["description"], found["strategies"]) == ("12 DA", "soft", ["css"])
    assert tried == [".price", "[class*=description]", "[class*=location]", "[class*=city]", "[class*=seller-name]", "[class*=store-name]"]


def test_falsy_values(spark):
    texts = ["0", '"0"', '"no number"', '""', "[]", "{}", "false", "true", "null", "0.0", "7", "[0]"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", is_falsy(F.parse_json("x")).alias("v"))
    assert [x for x, r in zip(texts, rows.orderBy("i").collect(), strict=True) if r.v] == ["0", '""', "[]", "{}", "false", "null", "0.0"]
