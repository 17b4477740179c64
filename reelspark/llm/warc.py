"""WARC archives as a chunked record table: payloads pass in pieces with incremental digests."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.text import only
from reelspark.session import broadcast_if_small, materialise, shared_folder

CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 256 << 20
MIN_REVISIT_BYTES = 1_000
_READ_BYTES = 1 << 18
_BATCH_BYTES = 8 << 20

_MANIFEST = "archive string, records long, bytes long"
_CHUNKS = (
    "archive string, offset long, record_id string, page_id string, record_type string, refers_to string, "
    "stated_digest string, chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean"
)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """A file system and path for the shared folder, whatever store its address names."""
    if re.match(r"[a-z][a-z0-9+.-]*:/", folder):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
    return pafs.LocalFileSystem(), folder


def _header(text: object) -> str:
    """A header value on one line: control characters are percent-encoded, an address stays as it is otherwise."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(text))


def _private(text: object) -> str:
    """A value of this module's own fields, which comes back whatever its characters."""
    return _header(str(text).replace("%", "%25"))


def _plain(text: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


class _Archive:
    """One archive being written: a gzip member per record, payload in pieces."""

    def __init__(self, fs: pafs.FileSystem, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self.records = self.bytes = 0
        self._fs, self._out = fs, fs.open_output_stream(self.path, compression=None)

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self.bytes += len(data)

    def add(self, fields: dict[str, object], pieces: Iterator[memoryview]) -> None:
        gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
        lines = "".join(f"{name}: {_header(value)}\r\n" for name, value in fields.items())
        self._put(gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode()))
        for piece in pieces:
            self._put(gzip.compress(piece))
        self._put(gzip.compress(b"\r\n\r\n"))
        self._put(gzip.flush())
        self.records += 1

    def close(self) -> dict[str, object]:
        self._out.close()
        return {"archive": self.path, "records": self.records, "bytes": self.bytes}


def _pieces(payload: memoryview, size: int) -> Iterator[memoryview]:
    for start in range(0, len(payload), size):
        yield payload[start : start + size]


def write_archives(records: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, payload, digest, record_type, refers_to) as archives; the manifest of those written.

    A task writes each payload straight from the Arrow buffer in pieces, so no record is copied
    whole. Archive names are new for each attempt and only the manifest, which Spark commits,
    makes them part of the result: a lost or repeated task leaves an unlisted file at most.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        archive, done = None, []
        for batch in batches:
            small = batch.drop_columns(["payload"]).to_pylist()
            for row, cell in zip(small, batch.column("payload"), strict=True):
                payload = memoryview(cell.as_buffer()) if row["record_type"] == "response" else memoryview(b"")
                fields = {
                    "WARC-Type": row["record_type"],
                    "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                    "WARC-Date": f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}",
                    "WARC-Target-URI": "" if row["url"] is None else row["url"],
                    "WARC-Payload-Digest": f"sha1:{row['digest']}",
                    "Page-ID": "" if row["page_id"] is None else _private(row["page_id"]),
                    "Content-Type": "text/html",
                    "Content-Length": len(payload),
                }
                if row["record_type"] == "revisit":
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    fields["Refers-To-Page-ID"] = _private(row["refers_to"])
                if archive is None:
                    archive = _Archive(fs, path)
                archive.add(fields, _pieces(payload, chunk_bytes))
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return materialise(records.mapInArrow(write, _MANIFEST))


def _members(stream: pa.NativeFile) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Offset and decompressed pieces of each gzip member; a consumer reads one to its end."""
    offset, rest = 0, b""

    def pieces() -> Iterator[bytes]:
        nonlocal offset, rest
        gunzip = zlib.decompressobj(31)
        while not gunzip.eof:
            rest = rest or stream.read(_READ_BYTES)
            piece = gunzip.decompress(rest, _READ_BYTES)
            if not rest and not piece:
                raise ValueError("archive ends inside a record")
            tail = gunzip.unused_data if gunzip.eof else gunzip.unconsumed_tail
            offset, rest = offset + len(rest) - len(tail), tail
            yield piece

    while True:
        rest = rest or stream.read(_READ_BYTES)
        if not rest:
            return
        yield offset, pieces()


def _records(stream: pa.NativeFile, chunk_bytes: int) -> Iterator[dict[str, object]]:
    """Chunk rows of all records: bytes seen and digest so far, never a whole payload.

    A response whose bytes do not meet its stated digest is an error.
    """
    for offset, pieces in _members(stream):
        head = b""
        while (end := head.find(b"\r\n\r\n")) < 0:
            head += next(pieces)
        names = dict(line.split(": ", 1) for line in head[:end].decode().split("\r\n")[1:])
        held, left = bytearray(head[end + 4 :]), int(names["Content-Length"])
        row = {
            "offset": offset,
            "record_id": names["WARC-Record-ID"],
            "page_id": _plain(names["Page-ID"]) or None,
            "record_type": names["WARC-Type"],
            "refers_to": _plain(names["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in names else None,
            "stated_digest": names["WARC-Payload-Digest"].removeprefix("sha1:"),
        }
        sha, seen, number = hashlib.sha1(), 0, 0
        while True:
            want = min(chunk_bytes, left)
            while len(held) < want:
                held += next(pieces)
            data = bytes(held[:want])
            del held[:want]
            sha.update(data)
            seen, left = seen + want, left - want
            yield row | {
                "chunk_no": number, "data": data, "bytes_so_far": seen,
                "digest_so_far": sha.copy().hexdigest(), "last": left == 0,
            }
            if left == 0:
                break
            number += 1
        if row["record_type"] == "response" and sha.hexdigest() != row["stated_digest"]:
            raise ValueError(f"payload of {row['record_id']} differs from its stated digest")
        for _ in pieces:  # the blank lines after the payload
            pass


def read_chunks(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the listed archives: one row per record and chunk number.

    Memory per task is one chunk and one Arrow batch, whatever a record's length. A record
    without payload has one empty chunk. ``with_data=False`` reads and digests all bytes but
    leaves ``data`` null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(folder)
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                with fs.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for row in _records(stream, chunk_bytes):
                        size += len(row["data"]) + 512
                        rows.append(row | {"archive": path} | ({} if with_data else {"data": None}))
                        if size >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    text = ("archive", "record_id", "page_id", "record_type", "refers_to", "stated_digest", "digest_so_far")
    kinds = dict.fromkeys(text, pa.string()) | dict.fromkeys(("offset", "chunk_no", "bytes_so_far"), pa.int64())
    kinds |= {"data": pa.binary(), "last": pa.bool_()}
    schema = pa.schema([(name.split()[0], kinds[name.split()[0]]) for name in _CHUNKS.split(", ")])
    # One archive a task: archives are the unit of parallel reading.
    listed = manifest.select("archive")
    spread = listed.repartition(max(1, listed.count()), "archive")
    return spread.mapInArrow(read, _CHUNKS)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload) -> the same with digest, record_type and refers_to.

    Of equal payloads of at least ``min_bytes``, the largest page_id is the response and others
    revisit it. Only digests found twice go back to the rows.
    """
    digested = pages.withColumn("digest", F.sha1("payload"))
    light = digested.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
    groups = light.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = materialise(groups)
    joined = digested.join(broadcast_if_small(groups, groups.count(), 128), "digest", "left")
    large = F.octet_length("payload") >= min_bytes
    revisit = large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).cast("string").alias("refers_to"),
    )


def archive_pages(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a WARC record and read the archives back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, archive, chunks.

    A null html is an empty payload, a null url an empty target. A null page_id is written and
    read back as null; if all copies of a payload lack an id, all are responses. Rows repeated
    with the largest page_id of their payload are all responses. An empty table gives no archive
    and no rows. Extra columns are ignored. A revisit has no payload; its length is that of the
    response it refers to.
    """
    id_type = df.schema[page_id].dataType
    pages = only(df, page_id=page_id, url=url, html=html)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/warc/{uuid.uuid4().hex}"
    manifest = write_archives(plan_records(pages.select("page_id", "url", payload)), folder)
    summary = [
        "archive", "page_id", "record_type", "refers_to", "stated_digest", "digest_so_far", "bytes_so_far", "chunk_no",
    ]
    read = read_chunks(manifest, folder, with_data=False).where("last").select(*summary)
    whole = materialise(read)
    lengths = (
        whole.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("digest_so_far").alias("stated_digest"))
        .agg(F.max("bytes_so_far").alias("whole_bytes"))
    )
    joined = whole.join(lengths, ["refers_to", "stated_digest"], "left")
    is_revisit = F.col("record_type") == "revisit"
    pick: Column = F.when(is_revisit, F.col("stated_digest")).otherwise(F.col("digest_so_far"))
    return joined.select(
        F.col("page_id").cast(id_type).alias("page_id"),
        F.when(is_revisit, F.col("whole_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        pick.alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
        "archive",
        (F.col("chunk_no") + 1).alias("chunks"),
    )
