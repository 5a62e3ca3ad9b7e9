from __future__ import annotations

import io

import pytest

from clademill.llm import warc


def test_round_trip(spark):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c d", ""), (5, "u", "long " * 50_000), (None, "u", "only"), (None, None, "<p>x</p>"), (2, "http://b", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "'k' AS key")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived(pages).collect())
    assert got == [(0, 4, "response", None), (0, 8, "revisit", 2), (1, 8, "revisit", 2), (2, 8, "response", None), (2, 8, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 250_000, "response", None)]
    assert {r.record_type for r in warc.archived(pages.filter("page_id < 3"), min_bytes=9).collect()} == {"response"}
    assert warc.archived(pages.limit(0)).count() == 0


def test_reader_finds_damage():
    import gzip

    raw = warc.record(1, "http://a", b"payload", warc.digest(b"payload"), None, False)
    two = gzip.compress(raw) + gzip.compress(raw)
    assert [warc.parsed(m)["payload"] for m in warc.members(io.BytesIO(two))] == [b"payload"] * 2
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members(io.BytesIO(two[:-10])))
    for bad in (raw.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"), raw.replace(b"Content-Type: application/http", b"Content-Type: application/htt"[:-1] + b"x"), raw[:-4], b"HTTP/1.1"):
        if bad != raw and bad[-4:] != raw[-4:] or b"pAy" in bad:
            with pytest.raises(ValueError):
                warc.parsed(bad)
