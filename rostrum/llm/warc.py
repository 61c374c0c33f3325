"""Web archives in seekable Zstandard bundles.

A bundle is a sequence of independent frames, each of whole WARC/1.1 records up
to :data:`FRAME` bytes; then a skippable frame with the index, which maps each
record identifier to its frame, its offset in the frame's data and its length;
then the seek table of the seekable format in a skippable frame with a footer,
so that a reader finds any record from the end of the file with two reads and
one frame.

Payloads that occur more than once are stored once: of the records with equal
payloads of at least ``min_revisit`` bytes those of the largest page id are
responses, all others revisit it. A null payload counts as the empty one. Rows
that share the largest id are all responses. Rows of null id are written under
the identifier of no page and never serve as a target unless no other row has
the payload. Null URLs are left out of the headers. Equal payloads are found by
SHA-256; a payload, however long, stands in one frame. An empty table gives no
bundle; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import Output, bounded_batches, chunks, fresh_path, materialise, open_input

#: Uncompressed bytes after which a frame is closed, and compressed bytes after which a bundle is.
FRAME, BUNDLE = 1 << 18, 1 << 29
#: Records of a bundle at most: its index is held in memory.
RECORDS = 1 << 20
#: Fixed values of the seekable format: skippable frames of the index and the table, and the footer's mark.
INDEX_MAGIC, TABLE_MAGIC, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: All records of a run carry one date, so that equal inputs give equal bundles.
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    return int(record[10:-1]) if record and len(record) > 11 else None


def record(page_id: int | None, url: str | None, payload: bytes, target: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, with the payload's length, and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(target)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """WARC header, HTTP header, body and end of the record that starts at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    head = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
    start, size = end + 4, int(head["Content-Length"])
    stop = data.index(b"\r\n\r\n", start)
    http = dict(x.split(": ", 1) for x in data[start:stop].decode().split("\r\n")[1:])
    return head, http, data[stop + 4 : start + size], start + size + 4


class Bundle:
    """Writes one bundle; holds one frame and the index in memory."""

    def __init__(self, stream, frame: int = FRAME):
        self.stream, self.frame, self.pack = stream, frame, zstandard.ZstdCompressor(level=3)
        self.frames, self.index, self.held, self.at, self.written = [], {}, [], 0, 0

    def add(self, name: str, data: bytes) -> None:
        self.index.setdefault(name, []).append((len(self.frames), self.at, len(data)))
        self.held.append(data)
        self.at += len(data)
        if self.at >= self.frame:
            self.flush()

    def flush(self) -> None:
        if self.held:
            data = self.pack.compress(b"".join(self.held))
            self.stream.write(data)
            self.frames.append((len(data), self.at))
            self.written += len(data)
            self.held, self.at = [], 0

    def finish(self) -> None:
        self.flush()
        index = self.pack.compress(json.dumps(self.index, separators=(",", ":")).encode())
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<II", *x) for x in [*self.frames, (len(index) + 8, 0)]) + struct.pack("<IBI", len(self.frames) + 1, 0, SEEKABLE)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class Reader:
    """Random and sequential access to a bundle."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        size = self.file.size()
        self.file.seek(size - 9)
        n, _, mark = struct.unpack("<IBI", self.file.read(9))
        if mark != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        self.file.seek(size - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * n)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed
        self.unpack = zstandard.ZstdDecompressor()

    def index(self) -> dict[str, list[list[int]]]:
        """Frame, offset and length of each record of an identifier."""
        at, packed, _ = self.frames[-1]
        self.file.seek(at + 8)
        return json.loads(self.unpack.decompress(self.file.read(packed - 8)))

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        self.file.seek(at)
        return self.unpack.decompress(self.file.read(packed), max_output_size=plain)

    def records(self, name: str) -> list[bytes]:
        return [self.frame(k)[at : at + n] for k, at, n in self.index().get(name, [])]

    def __iter__(self) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
        for k in range(len(self.frames) - 1):
            data, at = self.frame(k), 0
            while at < len(data):
                head, http, body, at = parse(data, at)
                yield head, http, body


def write(pages: DataFrame, *, min_revisit: int = 0, frame: int = FRAME, bundle: int = BUNDLE, records: int = RECORDS) -> DataFrame:
    """Write the bundles of ``pages`` (``page_id``, ``url``, ``html``); returns ``uri`` and ``n_records`` of each.

    A frame is closed after ``frame`` bytes, a bundle after ``bundle`` compressed bytes or ``records`` records.
    """
    bounded_batches(pages.sparkSession)
    folder = fresh_path(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    key = F.sha2(F.col("html"), 256)
    target = rows.where(F.octet_length("html") >= min_revisit).groupBy(key.alias("key")).agg(F.max("page_id").alias("target"))
    joined = rows.withColumn("key", key).join(target, "key", "left")
    joined = joined.select("page_id", "url", "html", "target", (F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), (r for b in chunks(batches, "html", 4 << 20) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            uri, n = f"{folder}/{part:06d}-{uuid.uuid4().hex}.warc.zst", 0
            with Output(uri) as stream:
                out = Bundle(stream, frame)
                while row is not None and out.written < bundle and n < records:
                    page_id, url, html, target, revisit = row
                    out.add(record_id(page_id), record(page_id, url, html.encode(), target, revisit))
                    n += 1
                    row = next(rows, None)
                out.finish()
            yield pa.RecordBatch.from_pydict({"uri": [uri], "n_records": [n]})

    return materialise(joined.mapInArrow(run, "uri string, n_records long"), "warc-files")


def read(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``.

    Length and digest of a response are taken from its payload, those of a revisit from its headers.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows = []
                for head, http, body in Reader(uri):
                    kind = head["WARC-Type"]
                    whole = (len(body), digest(body)) if kind == "response" else (int(http["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"))
                    rows.append((page_of(head["WARC-Record-ID"]), *whole, kind, page_of(head.get("WARC-Refers-To")), head.get("WARC-Target-URI")))
                    if len(rows) >= 5000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    n = bundles.count()
    return bundles.select("uri").repartition(max(1, n)).mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
