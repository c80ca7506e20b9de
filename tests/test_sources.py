import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import announcements, normalize, report
from tidemark.sources import config, landed, sinks
from tidemark.streaming import ingest

AT = "2026-01-01T00:00:00Z"


def sample(spark):
    records = [{"id": i, "slug": "s", "title": f"t{i}", "medias": [{"mediaUrl": f"https://i.e.com/{i}.jpg"}] * (i % 2)} for i in (10, 9, 2)]
    payloads = spark.createDataFrame([(json.dumps(r),) for r in records], "payload string")
    return normalize.normalize_listings(announcements.parse_announcements(payloads, "https://e.com", AT, "e").drop("rejected"))


def test_exports(spark, tmp_path):
    listings = sample(spark)
    state = spark.createDataFrame([("SUCCESS", None)], "status string, error string")
    full = report.quality_report(listings, state)
    out = sinks.export_all(listings, full, str(tmp_path))
    assert out == {"total_listings": 3, "with_price": 0, "with_images": 1, "with_description": 0, "with_location": 0, "duplicates": 0, "failed": 0}
    lines = [json.loads(line) for f in sorted((tmp_path / "listings.jsonl").glob("part-*")) for line in f.read_text().splitlines()]
    assert [x["external_id"] for x in lines] == ["2", "9", "10"] and lines[0]["category"] is None
    array = json.loads((tmp_path / "listings.json").read_text())
    assert [x["title"] for x in array] == ["t2", "t9", "t10"]
    images = [json.loads(line) for f in (tmp_path / "images.jsonl").glob("part-*") for line in f.read_text().splitlines()]
    assert [(x["external_id"], x["position"]) for x in images] == [("9", 0)]
    assert json.loads((tmp_path / "data-quality.json").read_text())["discovered"] == 1


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    box, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for day in (1, 2):
        spark.createDataFrame([(json.dumps({"id": day, "slug": "s", "title": f"t{day}"}),), (json.dumps({"title": "no id"}),)], "value string").write.mode("append").text(box)
        ingest.ingest(ingest.payload_stream(spark, box), "https://e.com", AT, "e", out, mark).awaitTermination()
    rows = spark.read.parquet(out).orderBy("external_id").collect()
    assert [(r.external_id, r.title) for r in rows] == [("1", "t1"), ("2", "t2")]


def test_search_pages_and_menu(spark):
    nodes = [{"id": 1, "slug": "a"}, {"id": 1, "slug": "b"}, {"id": None, "slug": "c"}, {"id": 2}, {"id": "3", "slug": "c"}, "text"]
    page = lambda n, more: json.dumps({"search": {"announcements": {"data": n, "paginatorInfo": {"hasMorePages": more, "lastPage": 7, "total": 9}}}})
    pages = landed.search_pages(spark.createDataFrame([(1, page(nodes, True)), (2, page([], True))], "page int, payload string"))
    assert [(r.page, r.has_more, r.last_page) for r in pages.orderBy("page").collect()] == [(1, True, 7), (2, False, 7)]
    found = landed.discovered(pages, "https://e.com").orderBy("seq").collect()
    assert [(r.external_id, r.url) for r in found] == [("1", "https://e.com/a-d1"), ("3", "https://e.com/c-d3")]
    menu = json.dumps({"listingMenu": [{"target": {"slug": "x"}}, {"target": None}, {"target": {"slug": "y"}}, {"target": {"slug": "x"}}]})
    top = landed.menu_categories(spark.createDataFrame([(menu,)], "payload string"))
    assert [r.slug for r in top.orderBy("pos").collect()] == ["x", "y"]
    kids = json.dumps({"search": {"active": {"category": {"children": [{"slug": "x1"}, {"slug": ""}, {"slug": "x2"}]}}}})
    got = landed.child_categories(top, spark.createDataFrame([("x", kids), ("y", "{}")], "slug string, payload string"))
    assert [r.slug for r in got.orderBy("pos").collect()] == ["x1", "x2", "y"]


def test_detail_answers_and_lines(spark):
    answers = spark.createDataFrame([("u1", '{"announcement": {"id": 1}}'), ("u2", '{"announcement": null}'), ("u3", "broken")], "url string, payload string")
    records, missing = landed.found_records(answers)
    assert [(r.url, r.payload) for r in records.collect()] == [("u1", '{"id":1}')]
    assert sorted(r.url for r in missing.collect()) == ["u2", "u3"]
    row = landed.event_lines(spark.createDataFrame([("x event=response url=https://e.com status=503 error='a b' n=1",), ("other",)], "value string")).collect()
    assert [tuple(r) for r in row] == [("response", "https://e.com", 503, "a b")]


def test_settings(tmp_path):
    (tmp_path / "config").mkdir()
    file = tmp_path / "config" / "run.yaml"
    file.write_text("max_pages: 5  # few\ncategories:\n  - a\n  - b\nsave_raw_html: true\nbase_url: 'https://e.com'\n")
    (tmp_path / ".env").write_text("MAX_PAGES=6\nPAGE_SIZE=\"10\"\nRETRY_COUNT=\n")
    s = config.load_settings(str(file), {"page_size": 12, "data_dir": None}, {"MAX_PAGES": "7", "CATEGORY_DEPTH": "2", "HOME": "x"})
    assert (s.max_pages, s.page_size, s.categories, s.save_raw, s.base_url, s.category_depth, s.retry_count) == (7, 12, ("a", "b"), True, "https://e.com", 2, 3)
    file.write_text("no_such: 1\n")
    with pytest.raises(ValueError):
        config.load_settings(str(file), environ={})
    with pytest.raises(ValueError):
        config.Settings(page_size=101)


def test_numeric_ids(values):
    assert values(landed.numeric_id(F.col("x")), ["12", " 7x", "x", "", "99999999999999999999"]) == [12, 7, 0, 0, 0]
