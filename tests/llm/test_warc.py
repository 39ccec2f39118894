"""Round trip of records, and the index against a full scan."""

import base64
import hashlib
import random

import pytest

from reelspark.llm import warc as w

PAGES = "page_id bigint, url string, html string, sha1 string, key string"


@pytest.fixture
def pages(spark):
    rng = random.Random(4)
    bodies = ["", "é" * 500, "<html>\r\n\r\n</html>", *["x" * n for n in range(1, 30)]]
    rows = [(k, f"http://h{k % 7}.example.org/p/{k % 50}?q={k % 3}", rng.choice(bodies), None, None) for k in range(400)]
    rows += [(1000, None, None, None, None), (1001, "http://[bad", "x", None, None), (1002, "a\r\nb: c", "x", None, None),
             (1003, "http://h.example", "y" * 3_000_000, None, None), (1004, "http://h.example", "y" * 3_000_000, None, None)]
    return spark.createDataFrame(rows, PAGES).repartition(5)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(pages, tmp_path, least):
    rows = {r.page_id: r for r in pages.collect()}
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i].html or "", i)
    got = w.archive_pages(pages, f"file://{tmp_path}", least).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        html = rows[r.page_id].html or ""
        size = len(html.encode())
        original = first[html] if size >= least else r.page_id
        assert (r.payload_bytes, r.payload_digest) == (size, digest(html))
        assert r.record_type == ("response" if original == r.page_id else "revisit")
        assert r.refers_to == (None if original == r.page_id else original)
        assert r.payload == (html.encode() if original == r.page_id else None)


def test_index_finds_all_captures_of_a_url(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(w, "BLOCK", 7)
    captures = w.write_archives(pages, f"file://{tmp_path}")
    manifest = w.write_index(captures, f"file://{tmp_path}", files=4)
    everything = w.read_index(manifest).collect()
    assert len(everything) == 405 and manifest.count() == 4
    urls = [f"http://h{k % 7}.example.org/p/{k % 50}?q={k % 3}" for k in range(0, 400, 9)] + ["http://none.example/"]
    got = sorted(r.page_id for r in w.lookup(spark.createDataFrame([(u,) for u in urls], "url string"), manifest).collect())
    keys = {w.url_key(u) for u in urls}
    assert got == sorted(r.page_id for r in everything if r.key in keys)
    assert sorted(r.page_id for r in w.read_records(captures.filter("page_id < 5")).collect()) == [0, 1, 2, 3, 4]
    assert sorted(w.lookup(pages, manifest).collect()) == sorted(everything)


def test_a_key_that_fills_many_index_files(spark, tmp_path, monkeypatch):
    """Urls that differ and share a key, some repeated or null: every capture comes once, out of all its files."""
    monkeypatch.setattr(w, "BLOCK", 3)
    rows = [(k, ["http://a.example/", "https://A.example", "http://a.example"][k % 3], "x", None, None) for k in range(200)]
    rows += [(200, None, "", None, None), (201, "", "", None, None), (202, "http://b.example/", None, None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    manifest = w.write_index(w.write_archives(pages, f"file://{tmp_path}"), f"file://{tmp_path}", files=8)
    assert manifest.filter("first_key = last_key and first_key = 'example,a)/'").count() > 1
    assert sorted(r.page_id for r in w.lookup(pages, manifest).collect()) == list(range(203))
    some = spark.createDataFrame([("http://a.example/",), ("HTTPS://a.example",), ("http://zzz.example/",)], "url string")
    assert sorted(r.page_id for r in w.lookup(some, manifest).collect()) == list(range(200))
    assert w.lookup(some.filter("url is null"), manifest).collect() == []


def test_keys():
    assert w.url_key("http://WWW.Example.org/A?b=C") == "org,example,www)/a?b=c"
    assert w.url_key("https://example.org") == "org,example)/" and w.url_key("http://e.org:81/") == "org,e:81)/"
    assert w.url_key(None) == ")/"


def test_damage_is_noticed():
    member = w.record(1, "u", b"payload", digest("other"), None)
    with pytest.raises(ValueError):
        w.parse(member)


def test_odd_rows(spark, tmp_path):
    rows = [(None, "u", "x", None, None), (None, "u", "x", None, None), (5, "u", "x", None, None), (5, "u", "x", None, None)]
    got = w.archive_pages(spark.createDataFrame(rows, PAGES), f"file://{tmp_path}").collect()
    assert len(got) == 4 and {r.record_type for r in got} == {"response"}
    assert w.archive_pages(spark.createDataFrame([], PAGES), f"file://{tmp_path}/n").collect() == []
