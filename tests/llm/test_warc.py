"""Round trip through archives, pieces with running digests, revisits, edge cases."""

import hashlib
import os
import re

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from reelspark.llm import warc
from reelspark.session import shared_folder

BIG = "page é漢 \r\n\r\nWARC/1.1\r\n" * 400


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://b\r\nX: y", BIG + "!"), (4, None, None), (5, "http://c", ""),
        (6, "u%0A", "short"), (7, "u", "short"), (None, "n", BIG), (2, "http://a/2", BIG), (8, "long", "x" * 3_000_000),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id BIGINT, url STRING, html STRING, digest STRING, archive INT")


def test_records_come_back(pages):
    got = sorted(map(tuple, warc.archive_pages(pages).drop("archive").collect()), key=repr)
    expected = []
    for row in pages.collect():
        payload = (row["html"] or "").encode()
        revisit = row["html"] == BIG and row["page_id"] != 2
        chunks = 1 if revisit else max(1, -(-len(payload) // warc.CHUNK_BYTES))
        kind, refers = ("revisit", 2) if revisit else ("response", None)
        expected.append((row["page_id"], len(payload), hashlib.sha1(payload).hexdigest(), kind, refers, chunks))
    assert got == sorted(expected, key=repr)


def test_chunk_table_streams_with_running_digests(spark, pages):
    folder = f"{shared_folder(spark)}/warc-test"
    records = warc.plan_records(pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")))
    manifest = warc.write_archives(records, folder, chunk_bytes=1_000, archive_bytes=2_000)
    assert manifest.agg(F.sum("records")).first()[0] == pages.count() and manifest.count() > 1
    chunks = warc.read_chunks(manifest, folder, chunk_bytes=777).orderBy("archive", "offset", "chunk_no").collect()
    whole = {}
    for c in chunks:
        before = whole.get((c["archive"], c["offset"]), b"")
        assert len(c["data"]) <= 777 and c["bytes_so_far"] == len(before) + len(c["data"])
        whole[c["archive"], c["offset"]] = now = before + bytes(c["data"])
        assert c["digest_so_far"] == hashlib.sha1(now).hexdigest()
        if c["last"] and c["record_type"] == "response":
            assert c["digest_so_far"] == c["stated_digest"]
    assert sorted(c["record_id"] for c in chunks if c["last"]) == sorted({c["record_id"] for c in chunks})


def test_archives_are_plain_warc(spark, pages):
    folder = f"{shared_folder(spark)}/warc-plain"
    records = warc.plan_records(pages.where("page_id = 6").select("page_id", "url", F.col("html").cast("binary").alias("payload")))
    path = warc.write_archives(records, folder).first()["archive"]
    with pafs.LocalFileSystem().open_input_stream(path, compression="gzip") as stream:
        head, payload = stream.read().split(b"\r\n\r\n", 1)
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    assert head.startswith(b"WARC/1.1\r\n") and payload == b"short\r\n\r\n"
    assert fields[b"WARC-Type"] == b"response" and fields[b"Content-Length"] == b"5"
    assert os.path.basename(path).endswith(".warc.gz")


def one_archive(spark, folder, rows):
    pages = spark.createDataFrame(rows, "page_id STRING, url STRING, payload BINARY")
    return warc.write_archives(warc.plan_records(pages), folder)


def test_addresses_are_written_as_they_are(spark, tmp_path):
    path = one_archive(spark, str(tmp_path), [("p%41\n", "http://a/b%20c?x=%2F\r\nX: y", bytearray(b"z"))]).first()["archive"]
    with pafs.LocalFileSystem().open_input_stream(path, compression="gzip") as stream:
        fields = dict(line.split(b": ", 1) for line in stream.read().split(b"\r\n\r\n", 1)[0].split(b"\r\n")[1:])
    assert fields[b"WARC-Target-URI"] == b"http://a/b%20c?x=%2F%0D%0AX: y"
    assert re.fullmatch(rb"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields[b"WARC-Date"])


def test_own_fields_come_back(spark, tmp_path):
    manifest = one_archive(spark, str(tmp_path), [(p, "u", bytearray(b"z" * 2_000)) for p in ("p%41\n", "p%", "a%0A")])
    rows = warc.read_chunks(manifest, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in rows) == [("a%0A", "p%41\n"), ("p%", "p%41\n"), ("p%41\n", None)]


def test_a_changed_payload_is_an_error():
    import gzip
    import io

    lines = "WARC-Type: response\r\nWARC-Record-ID: r\r\nPage-ID: 1\r\nContent-Length: 3\r\nWARC-Payload-Digest: sha1:"
    for payload, right in ((b"abc", True), (b"abd", False)):
        head = f"WARC/1.1\r\n{lines}{hashlib.sha1(b'abc').hexdigest()}\r\n\r\n".encode()
        archive = io.BytesIO(gzip.compress(head + payload + b"\r\n\r\n"))
        if right:
            assert [r["bytes_so_far"] for r in warc._records(archive, 2)] == [2, 3]
        else:
            with pytest.raises(ValueError, match="differs"):
                list(warc._records(archive, 2))


def test_no_pages(pages):
    assert warc.archive_pages(pages.limit(0)).collect() == []
