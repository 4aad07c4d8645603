"""WARC archives: exact round trip, revisits, pushed predicates."""

import hashlib

import pytest
from pyspark.sql import functions as F

from columnlens.llm import warc
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import against_sql

LONG = "<p>same</p>" * 20
PAGES = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (1, "http://b", "short"), (2, "http://b\r\n", "short"),
    (4, "http://c/é", None), (6, "", "a\r\n\r\nb\0" + "é" * 100), (7, "http://d", "x" * 600_000), (3, "http://a/2", LONG), (None, "http://n", "n"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("codec", ["gzip", "none"])
def test_round_trip(spark, pages, codec):
    path = warc.write_archive(warc.archive_records(pages, "page_id", "url", "html"), codec=codec)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(PAGES)
    by = {}
    for r in got:
        by.setdefault(r["record_id"], []).append(r)
    for key, url, html in PAGES:
        data = (html or "").encode()
        for r in by[None if key is None else str(key)]:
            assert r["payload_digest"] == hashlib.sha256(data).hexdigest() and r["payload_length"] == len(data)
            revisit = html == LONG and key != 3
            assert r["record_type"] == ("revisit" if revisit else "response")
            assert r["refers_to"] == ("3" if revisit else None)
            assert revisit or bytes(r["payload"]) == data
            assert r["target_uri"] == (url.replace("\r", "%0D").replace("\n", "%0A") if url is not None else None)


def test_pushdown(spark, pages):
    path = warc.write_archive(warc.archive_records(pages, "page_id", "url", "html"))
    df = warc.read_archive(spark, path).where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a"))
    assert {r["record_id"] for r in df.collect()} == {"5"}
    reader = warc.WarcReader(path, True)
    rest = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)]))
    assert len(rest) == 1 and reader.tests == [("record_type", "EqualTo", "revisit")]
    bare = warc.read_archive(spark, path, payload=False).collect()
    assert all(r["payload"] is None for r in bare)
    assert {r["payload_length"] for r in bare} == {len((h or "").encode()) for _, _, h in PAGES}


def test_empty(spark, pages):
    path = warc.write_archive(warc.archive_records(pages.limit(0), "page_id", "url", "html"))
    assert warc.read_archive(spark, path).count() == 0


@pytest.mark.parametrize("payload", [True, False])
def test_other_writers(spark, tmp_path, payload):
    """Only HTTP blocks have a head to split off, however long it is."""
    text = b"first paragraph\r\n\r\nsecond\r\n\r\nthird"
    http = b"HTTP/1.1 200 OK\r\n%sContent-Length: 11\r\n\r\n"
    made = [
        ("conversion", b"text/plain", text, text, len(text)), ("metadata", b"application/warc-fields", b"a: b\r\n", b"a: b\r\n", 6),
        ("resource", b"", b"no empty line", b"no empty line", 13), ("warcinfo", b"application/warc-fields", b"", b"", 0),
        ("conversion", b"text/plain", b"Content-Length: 99\r\n\r\nx", b"Content-Length: 99\r\n\r\nx", 23)]
    for n in (0, 1, *range(974, 985), 5000):  # the empty line across every border of the pieces read
        head = http % (b"X: " + b"y" * n + b"\r\n")
        made.append(("response", b"application/http; msgtype=response", head + b"ab\r\n\r\ncdefg", b"ab\r\n\r\ncdefg", 11))
    out = b""
    for i, (kind, mime, block, _, _) in enumerate(made):
        lines = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <%d>" % i] + ([b"Content-Type: " + mime] if mime else [])
        out += b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block, b"", b""])
    (tmp_path / "other.warc").write_bytes(out)
    got = sorted((int(r["record_id"]), r["record_type"], r["payload"] and bytes(r["payload"]), r["payload_length"])
                 for r in warc.read_archive(spark, str(tmp_path), payload=payload).collect())
    assert got == [(i, k, (p if payload else None) and bytes(p), n) if payload else (i, k, None, n) for i, (k, _, _, p, n) in enumerate(made)]


def test_query(spark):
    against_sql(spark, "op8_warc", QUERIES, ORACLE_SQL)
