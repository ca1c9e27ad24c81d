from __future__ import annotations

import hashlib
import os

import pytest
import zstandard

from dialogeval.llm import warc as w
from dialogeval.llm.queries import QUERIES
from dialogeval.sources import scratch

PAGES = "page_id bigint, url string, html string, digest string, size int"


def pages_of(spark, *rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], PAGES)


def rows_of(df):
    return sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


def brute(pages):
    largest, out = {}, []
    for i, html in pages:
        if i is not None and len((html or "").encode()) >= w.MIN_REVISIT_BYTES:
            largest[html] = max(largest.get(html, i), i)
    for i, html in pages:
        payload = (html or "").encode()
        to = largest.get(html) if i is not None else None
        revisit = to is not None and to > i
        out.append((str(i), len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out)


def test_tables(spark, sf_dir):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert rows_of(QUERIES["op9_warc"](spark, sf_dir)) == brute(pages)


def test_revisits_and_edges(spark):
    large, other = "ü" * 500, "x" * 999
    rows = [(1, "http://a/ b%\r\n", large), (5, None, large), (3, "u", large), (7, "u", other), (8, "u", other), (None, "u", large),
            (9, "u", None), (10, "u", ""), (5, "u", large), (11, "u", "\x00\r\n\r\n" * 400)]
    pages = pages_of(spark, *rows)
    assert rows_of(w.round_trip(pages)) == brute([(r[0], r[2]) for r in rows])
    folder = scratch.scratch_path(spark, "test-warc")
    archives = w.write_archives(pages, folder)
    got = w.read_archives(spark, folder, archives).collect()
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[1] == rows[0][1] and urls[3] == "u"
    kept = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bytes(kept[11]).decode() == rows[-1][2] and bytes(kept[5]).decode() == large
    assert w.round_trip(pages_of(spark)).count() == 0


def test_many_archives_with_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(w, "SAMPLE_BYTES", 20_000)
    rows = [(i, f"http://h/{i}", f"<html><p>page {i} of many</p></html>" * 9) for i in range(400)]
    folder = scratch.scratch_path(spark, "test-warc")
    archives = w.write_archives(pages_of(spark, *rows), folder, archive_bytes=1_000)
    # The limit is on compressed bytes: an archive ends with the record that reaches it.
    listed = archives.collect()
    assert len(listed) > 8 and sum(r["records"] for r in listed) == 400 and max(r["bytes"] for r in listed) < 2_000
    path = os.path.join(folder, archives.first()["archive"])
    raw = open(path, "rb").read()
    assert int.from_bytes(raw[:4], "little") == w.SKIPPABLE
    assert sorted(r["page_id"] for r in w.read_archives(spark, folder, archives).collect()) == list(range(400))
    # What a lost task left is not listed and not read.
    open(os.path.join(folder, "left-behind.warc.zst"), "wb").write(raw)
    assert w.read_archives(spark, folder, archives).count() == 400


def test_validation(tmp_path, spark):
    good = w.encode_record(1, "u", b"payload")
    assert w.decode_record(good)["payload"] == b"payload"
    for bad in (
        good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"payload\r", b"paylaod\r"),
        good.replace(b"WARC-Date", b"WARC-Dame"), good.replace(b"Content-Length", b"Content-Length: 1\r\nContent-Length", 1),
        b"", good + good, good.replace(b"response\r\nWARC-Record", b"request\r\nWARC-Record"),
    ):
        with pytest.raises(ValueError):
            w.decode_record(bad)
    frame = zstandard.ZstdCompressor().compress
    (tmp_path / "a.warc.zst").write_bytes(frame(good) + frame(good[:-3]) + frame(good)[:-4])
    rows = w.read_archives(spark, str(tmp_path), strict=False).orderBy("number").collect()
    assert [r["error"] is None for r in rows] == [True, False, False]
    with pytest.raises(Exception, match="record 1 of a.warc.zst"):
        w.read_archives(spark, str(tmp_path)).collect()
