from __future__ import annotations

import hashlib
import time
from collections import defaultdict

import pytest

from conftest import SMALL
from holdfast.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows):
    least = defaultdict(list)
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            least[data].append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = min(least[data]) if least.get(data) else page_id
        again = first != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def through(spark, rows, path):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages.withColumn("digest", pages["url"]).withColumn("payload", pages["url"]), path)
    return sorted(map(tuple, warc.page_records(spark, path).collect()), key=repr)


ROWS = [(i, f"http://h/{i}", f"<p>page {i} é😀</p>" * (i % 7)) for i in range(40)]
ODD = [
    (100, None, None), (101, "u", ""), (102, "u\r\nWARC-Type: x", "short"), (103, "u", "short"),
    (104, "u", "x" * 300), (99, "u", "x" * 300), (105, "u", "x" * 300), (99, "u", "x" * 300), (None, "u", "x" * 300),
    (106, "u", FAKE), (107, "u", "before" + FAKE * 40 + "after"), (108, "u", "WARC/1.1\r\n"), (109, "u", "WARC/1.1\r\n" * 30),
    (110, "u", "\r\n\r\n" * 9), (111, "u", "WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n"), (112, "u", "WARC/1.1\r\nContent-Length: 4\r\n\r\n1234"),
    (None, "u", "y" * 200), (113, "u", "z" * 500_000), (-5, "u", "tail\r\n\r\n"), (114, "u", FAKE.rstrip()),
]


def test_round_trip(spark, tmp_path):
    rows = ROWS + ODD
    assert through(spark, rows, str(tmp_path / "a")) == expected(rows)


@pytest.mark.parametrize("block", [700, 4001])
def test_blocks_cut_anywhere(spark, tmp_path, block):
    """Files read in many small blocks, magics and records across their borders."""
    rows = ROWS[:6] + [r for r in ODD if len(r[2] or "") < 10_000]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archive(pages, str(tmp_path / "a"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parts = warc._pieces(spark, str(tmp_path / "a")).select("file", "block").distinct().count()
        got = sorted(map(tuple, warc.page_records(spark, str(tmp_path / "a")).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert parts > 2 and got == expected(rows)


@pytest.mark.parametrize("digits", [18, 19, 20, 5000])
def test_no_length_ends_the_job(spark, tmp_path, digits):
    head = "WARC/1.1\r\nContent-Length: {}\r\n\r\n"
    rows = [(1, "u", head.format("9" * digits)), (2, "u", "x" + head.format("9" * digits) + "y" * 200)]
    rows += [(3, "u", head.format("0" * digits + "7")), (4, "u", "last")]
    assert through(spark, rows, str(tmp_path / "a")) == expected(rows)


def test_page_of_many_magics(spark, tmp_path):
    rows = [(1, "u", "WARC/1.1\r\n" * 100_000), (2, "u", ("a WARC/1.1\r\n" + "é" * 99) * 5_000), (3, "u", "end")]
    start = time.monotonic()
    assert through(spark, rows, str(tmp_path / "a")) == expected(rows)
    assert time.monotonic() - start < 60


def test_leading_zeros(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %s\r\n\r\n%s\r\n\r\n"
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.warc").write_bytes(record % (1, b"0" * 30 + b"2", b"ab") + record % (2, b"000", b""))
    got = warc.page_records(spark, str(tmp_path / "x")).select("page_id", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 0)]


def test_bytes_that_are_no_text(spark, tmp_path):
    """An archive from elsewhere, with a binary payload and junk before its first record."""
    payload = bytes(range(256)) * 3 + b"WARC/1.1\r\n" + b"\xff\xfe"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.warc").write_bytes(record % (len(payload), payload) + record % (1, b"q"))
    got = warc.read_records(spark, str(tmp_path / "x")).orderBy("at").collect()
    assert [(r["payload_bytes"], r["digest"]) for r in got] == [
        (len(payload), hashlib.sha256(payload).hexdigest()), (1, hashlib.sha256(b"q").hexdigest())]


def test_archive_text(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "hi")], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    files = [p.read_bytes() for p in (tmp_path / "a").iterdir() if p.name.startswith("part-")]
    text = b"".join(files).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\n")
    assert text.endswith("Content-Length: 2\r\n\r\nhi\r\n\r\n")


def test_no_pages(spark, tmp_path):
    assert through(spark, [], str(tmp_path / "a")) == []


def test_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    got = warc.op4_warc(spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected([tuple(r) for r in pages])
