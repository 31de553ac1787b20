from __future__ import annotations

import gzip
import hashlib
import os
import re

import pytest
from compare import connect, differences, spark_rows, sql_rows

from obsgrid.llm import warc
from obsgrid.llm.queries import ORACLES, QUERIES
from obsgrid.session import scratch_path

PAGES = "page_id long, url string, html string, payload string, digest string, header string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES)


BIG = "<p>é" + "x" * 200


def test_query_matches_sql(spark, sf_dir):
    found = spark_rows(QUERIES["op6_warc"](spark, sf_dir))
    assert differences(found, sql_rows(connect(sf_dir), ORACLES["op6_warc"])) == []


def test_records_are_whole(spark):
    rows = [(1, "http://a/", BIG), (2, "http://b/\r\nX: y", BIG), (3, None, "small"), (4, "", "small"), (5, "http://e/", None)]
    archive = warc.write_archive(pages(spark, rows))
    assert spark.read.parquet(archive.payloads).count() == 3
    got = {r["page_id"]: r for r in warc.read_archive(spark, archive).collect()}
    for page_id, _, text in rows:
        body = (text or "").encode()
        row = got[page_id]
        assert bytes(row["payload"]) == body
        assert row["payload_digest"] == hashlib.sha256(body).hexdigest()
        head, rest = bytes(row["record"]).split(b"\r\n\r\n", 1)
        block = rest[: int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])]
        assert rest[len(block) :] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        http, payload = block.split(b"\r\n\r\n", 1)
        assert http.startswith(b"HTTP/1.1 200") and payload == (b"" if page_id == 2 else body)
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", 1)
    assert {got[i]["record_type"] for i in (1, 3, 4, 5)} == {"response"}
    assert got[2]["url"] == "http://b/%0D%0AX: y"


def test_changed_and_missing_payloads_fail(spark):
    archive = warc.write_archive(pages(spark, [(1, "u", BIG), (2, "u", "other")]))
    stored = spark.read.parquet(archive.payloads)
    changed = scratch_path(spark, "changed")
    stored.selectExpr("digest", "encode(replace(decode(payload, 'utf-8'), 'x', 'y'), 'utf-8') as payload").write.parquet(changed)
    missing = scratch_path(spark, "missing")
    stored.where("length(payload) < 50").write.parquet(missing)
    for path in (changed, missing):
        with pytest.raises(Exception, match="payload missing or changed"):
            warc.read_archive(spark, warc.Archive(archive.headers, path)).select("payload_digest").collect()


def test_exported_files(spark, tmp_path):
    archive = warc.write_archive(pages(spark, [(1, "u", BIG), (2, "v", BIG), (3, "w", "small\r\n\r\ntext")]))
    path = str(tmp_path / "out")
    warc.export_warc(spark, archive, path)
    data = b"".join(gzip.open(f"{path}/{f}").read() for f in sorted(os.listdir(path)) if f.endswith(".gz"))
    want = {bytes(r["record"]) for r in warc.read_archive(spark, archive).collect()}
    found = set()
    while data:
        head = data.index(b"\r\n\r\n") + 4
        size = head + int(re.search(rb"\r\nContent-Length: (\d+)", data[:head])[1]) + 4
        found.add(data[:size])
        data = data[size:]
    assert found == want


def test_awkward_rows(spark):
    rows = [(7, "u", BIG), (7, "u", BIG), (9, None, BIG), (None, "n", BIG), (10, "z", "q" * 3_000_000)]
    archive = warc.write_archive(pages(spark, rows))
    got = warc.read_archive(spark, archive).select("page_id", "record_type", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == [
        (7, "response", 205), (7, "response", 205), (9, "revisit", 205), (10, "response", 3_000_000)
    ]
    empty = warc.write_archive(pages(spark, []))
    assert warc.read_archive(spark, empty).count() == 0
