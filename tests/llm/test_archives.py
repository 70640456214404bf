"""ZIP-packaged WARC archives."""

from __future__ import annotations

import base64
import gzip
import io
import zipfile
from hashlib import sha1

import pytest
from pyspark.sql import functions as F
from llm_helpers import SF_DIR

from authwatch.llm import warc_zip
from authwatch.llm.batches import new_folder

PAGE = "page_id long, url string, html string"


def brute(rows):
    largest = {}
    for page, html in rows:
        largest[html or ""] = max(largest.get(html or "", page), page)
    out = []
    for page, html in rows:
        data, winner = (html or "").encode(), largest[html or ""]
        out.append((page, len(data), base64.b32encode(sha1(data).digest()).decode(),
                    "response" if page == winner else "revisit",
                    None if page == winner else winner))
    return sorted(out)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    # A third of the pages once more, under ids of their own.
    again = pages.filter("page_id % 3 = 0").selectExpr("page_id + 100000 as page_id", "url", "html")
    rows += [(page + 100000, html) for page, html in rows if page % 3 == 0]
    got = warc_zip.round_trip(pages.select("page_id", "url", "html").unionByName(again),
                              new_folder(spark, "archives")).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u\r\nX: y", "é\r\n\r\nWARC/1.1"), (4, "u", "x"),
            (4, "u", "x"), (5, "u", "x"), (None, "u", "x"), (None, "u", "only"), (6, "u", "z" * 99999)]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 as digest", "2 as page", "3 as size")
    got = warc_zip.round_trip(pages, new_folder(spark, "archives")).collect()
    by = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str)
    assert by == sorted([
        (1, 0, "revisit", 2), (2, 0, "response", None), (3, 14, "response", None),
        (4, 1, "revisit", 5), (4, 1, "revisit", 5), (5, 1, "response", None),
        (None, 1, "revisit", 5), (None, 4, "response", None), (6, 99999, "response", None)], key=str)
    empty = warc_zip.round_trip(pages.filter("page_id > 100"), new_folder(spark, "archives"))
    assert empty.count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_are_zip_files(spark, zip64):
    rows = [(n, "u", f"<html>{n}</html>") for n in range(50)]
    folder = new_folder(spark, "archives")
    archives = warc_zip.write_archives(
        spark.createDataFrame(rows, PAGE).coalesce(1), folder, zip64=zip64)
    found = archives.collect()
    assert sum(row.records for row in found) == 50
    for row in found:
        with zipfile.ZipFile(row.path) as archive:
            assert archive.testzip() is None
            data = gzip.decompress(archive.read(warc_zip.RECORDS))
            assert data.count(b"WARC-Type: response") == row.records
        raw = open(row.path, "rb").read()
        members = warc_zip.central_directory(io.BytesIO(raw), len(raw))
        assert [m.name for m in members] == [warc_zip.RECORDS, warc_zip.INDEX]
        assert (warc_zip.END64 in raw) == zip64
    assert warc_zip.read_archives(archives, folder).count() == 50


def test_the_records_are_read_by_many_tasks(spark, monkeypatch):
    folder = new_folder(spark, "archives")
    rows = [(n, "u", f"<html>{n}</html>") for n in range(6000)]
    archives = warc_zip.write_archives(spark.createDataFrame(rows, PAGE).coalesce(2), folder)
    read = warc_zip.read_archives(archives, folder)
    tasks = read.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == 6000
    monkeypatch.setattr(warc_zip, "READ_BYTES", 10_000)
    size = archives.agg(F.sum("size")).first()[0]
    assert warc_zip.read_archives(archives, folder).rdd.getNumPartitions() == -(-size // 10_000)


def test_archives_of_others_are_read():
    """Stored members with and without extra fields and a comment at the end."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("a.txt", b"hello")
        archive.writestr("b.txt", b"more", zipfile.ZIP_DEFLATED)
        archive.comment = b"made elsewhere"
    members = {m.name: m for m in warc_zip.central_directory(out, len(out.getvalue()))}
    assert warc_zip.read_range(out, warc_zip.data_offset(out, members["a.txt"]), 5) == b"hello"
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.data_offset(out, members["b.txt"])
    with pytest.raises(ValueError, match="no ZIP"):
        warc_zip.central_directory(io.BytesIO(b"x" * 100), 100)


def test_a_damaged_record_is_seen():
    data = warc_zip.record_bytes("1", "u", b"payload", warc_zip.base32_sha1(b"payload"), None)
    with pytest.raises(ValueError, match="damaged"):
        warc_zip.parse_record(data.replace(b"payload\r\n", b"paYload\r\n"))
