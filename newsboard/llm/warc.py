"""WARC archives and the chunked record table.

Archives are written by tasks, a gzip member per record, and read back as a
table of chunks: (record, chunk number, data) with the number of payload bytes
and the SHA-1 so far.  Neither side holds more than a chunk of a record beyond
the cell it came in.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsboard.llm.common import hot_join, landed, open_for_read, open_for_write
from newsboard.plans.storage import shared_dir

LEAST_BYTES = 1000
CHUNK_BYTES = 1 << 16
FILE_BYTES = 1 << 28
SEGMENT_BYTES = 1 << 23
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEGMENTS_PER_TASK = 4
_GZIP = 31


def record_types(pages: DataFrame, id_col: str, payload: str, least: int = LEAST_BYTES) -> DataFrame:
    """``pages`` with payload_bytes, sha1 and keeper: the largest id of the
    records with the same payload, if it has ``least`` bytes and they are
    several, else NULL.  A payload with a third of all records is a hot key."""
    rows = pages.withColumns({"payload_bytes": F.octet_length(payload), "sha1": F.sha1(payload)})
    alike = (
        rows.select(id_col, "payload_bytes", "sha1")
        .filter(F.col("payload_bytes") >= least)
        .groupBy("sha1")
        .agg(F.max(id_col).alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    return hot_join(rows, landed(alike, "alike"), "sha1", "n", "left").drop("n")


def _head(record: dict, date: str) -> bytes:
    """Header of a record and of the HTTP response in it."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", record["url"] or "about:blank")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % record["payload_bytes"]
    body = 0 if record["refers_to"] is not None else record["payload_bytes"]
    digest = base64.b32encode(bytes.fromhex(record["sha1"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if record['refers_to'] is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if record['id'] is None else record['id']}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {record['payload_bytes']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + body}",
    ]
    if record["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <urn:page:{record['refers_to']}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_warc(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
    least: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a WARC record per row to ``.warc.gz`` files of the shared folder;
    returns their segments (path, first, until), byte ranges of whole records.

    Of the rows with equal payloads of at least ``least`` bytes, that with the
    largest id is a response and the others revisit it without the payload;
    rows with a smaller payload are responses.  Rows with the largest id and
    the same payload are responses each.  A NULL payload is empty; a NULL id is
    never the largest, and if there is no other id all are responses; a NULL
    url becomes about:blank, white space in it is escaped.  No rows give no
    files.

    A task that runs again writes files with new names; only those of the
    attempt that counts are in the result.
    """
    folder = shared_dir(pages.sparkSession, "warc")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = record_types(
        pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), body.alias("body")),
        "id", "body", least,
    )
    refers = F.when(~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    rows = rows.withColumn("refers_to", refers).select(
        "id", "url", "payload_bytes", "sha1", "refers_to", F.when(F.col("refers_to").isNull(), F.col("body")).alias("body")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, since, done = None, None, 0, 0, []
        for batch in batches:
            heads = batch.drop_columns(["body"]).to_pylist()
            for record, cell in zip(heads, batch.column("body"), strict=True):
                if out is None:
                    path, at, since = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = open_for_write(path)
                member = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                data = memoryview(cell.as_buffer()) if cell.is_valid else memoryview(b"")
                pieces = (data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES))
                for piece in (_head(record, date), *pieces, b"\r\n\r\n"):
                    at += out.write(member.compress(piece)) or 0
                at += out.write(member.flush()) or 0
                at = out.tell()
                if at - since >= SEGMENT_BYTES:
                    done.append((path, since, at))
                    since = at
                if at >= FILE_BYTES:
                    out.close()
                    if at > since:
                        done.append((path, since, at))
                    out = None
        if out is not None:
            out.close()
            if at > since:
                done.append((path, since, at))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done, strict=True)], ["path", "first", "until"]
            )

    return landed(rows.mapInArrow(write, "path string, first long, until long"), "warc-index")


def _inflated(path: str, first: int, until: int) -> Iterator[tuple[bool, bytes]]:
    """(new member?, bytes) of the gzip members in a byte range."""
    with open_for_read(path) as f:
        member, new, data = zlib.decompressobj(_GZIP), True, b""
        while True:
            if not data:
                if first >= until:
                    return
                data = f.read_at(min(1 << 18, until - first), first)
                first += len(data)
            out = member.decompress(data, CHUNK_BYTES)
            if out:
                yield new, out
                new = False
            if member.eof:
                data, member, new = member.unused_data, zlib.decompressobj(_GZIP), True
            else:
                data = member.unconsumed_tail


class _Record:
    """One record while its bytes stream by; yields its payload in chunks."""

    def __init__(self, size: int):
        self.size, self.raw, self.sha, self.seen = size, bytearray(), hashlib.sha1(), 0
        self.head, self.left, self.chunk = None, None, 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.raw += data
        if self.head is None:
            end = self.raw.find(b"\r\n\r\n")
            http = self.raw.find(b"\r\n\r\n", end + 4) if end >= 0 else -1
            if http < 0:
                return
            lines = self.raw[:end].decode().split("\r\n")
            self.head = dict(line.split(": ", 1) for line in lines[1:])
            self.left = int(self.head["Content-Length"]) - (http - end)
            del self.raw[: http + 4]
        while self.left and len(self.raw) >= min(self.size, self.left):
            n = min(self.size, self.left)
            yield from self._cut(bytes(self.raw[:n]))
            del self.raw[:n]

    def _cut(self, data: bytes) -> Iterator[tuple]:
        self.sha.update(data)
        self.seen += len(data)
        self.left -= len(data)
        yield self._row(data, self.left == 0)

    def _row(self, data: bytes, last: bool) -> tuple:
        h, number = self.head, lambda s: None if s in (None, "<urn:page:null>") else int(s[10:-1])
        stated = base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
        kind = h["WARC-Type"]
        if last and kind == "response" and self.sha.hexdigest() != stated:
            raise ValueError(f"{h['WARC-Record-ID']}: payload does not have its digest")
        self.chunk += 1
        return (
            h["WARC-Record-ID"], self.chunk - 1, data, self.seen, self.sha.hexdigest(), last, number(h["WARC-Record-ID"]),
            kind, h["WARC-Target-URI"], int(h["X-Payload-Length"]), stated, number(h.get("WARC-Refers-To")),
        )

    def close(self) -> Iterator[tuple]:
        if self.head is None or self.left:
            raise ValueError("a record of the archive is cut off")
        if not self.chunk:
            yield self._row(b"", True)


CHUNKS = (
    "record_id string, chunk int, data binary, bytes_so_far long, sha1_so_far string, last boolean, page_id long, "
    "record_type string, url string, payload_bytes long, payload_sha1 string, refers_to long"
)


def read_warc(segments: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of archives that ``write_warc`` wrote.

    A row per chunk of at most ``chunk_bytes`` payload bytes: record_id, chunk
    (from 0), data, bytes_so_far and sha1_so_far (both up to and with the
    chunk), last, and from the record's header page_id, record_type, url,
    payload_bytes, payload_sha1 and refers_to.  A record without payload has
    one empty chunk.  A response whose bytes do not have the digest stated, or
    a record that is cut off, is an error.  Tasks get ``SEGMENTS_PER_TASK``
    segments each, dealt evenly.
    """
    tasks = max(1, -(-segments.count() // SEGMENTS_PER_TASK))
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.int64(),
             pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    def chunks(segment: dict) -> Iterator[tuple]:
        record = None
        for new, data in _inflated(segment["path"], segment["first"], segment["until"]):
            if new:
                if record:
                    yield from record.close()
                record = _Record(chunk_bytes)
            yield from record.feed(data)
        if record:
            yield from record.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment in batch.to_pylist():
                rows, held = [], 0
                for row in chunks(segment):
                    rows.append(row)
                    held += len(row[2])
                    if held >= 4 << 20 or len(rows) >= 5000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return segments.repartition(tasks).mapInArrow(read, CHUNKS)
