"""WARC archives: one gzip member per record, written by tasks, read back as a stream.

Writing
    Each task writes archives of about ``ARCHIVE_BYTES`` under names of its own (partition, attempt, random part), and
    hands on a row per finished archive. Only archives named by a successful task count, so a retried task leaves at most
    an unnamed file behind. Records of equal payloads (``SMALLEST`` bytes or more) are revisits of the one with the
    smallest page id; a revisit has no payload, but names the payload's digest and length.

Reading
    An archive is read in pieces of ``PIECE`` bytes, each member inflated as it comes, headers up to the blank line, then as
    much as Content-Length says. Digests of blocks and payloads are verified as they pass; a bad length, digest or a cut
    archive raises an error. A task holds one record at most.

Files are opened through pyarrow's file systems, by the URI of the folder that all executors share.

Defined results
    A null html is an empty payload. A null page id is left out of the record and comes back null; it is never referred to
    while another page has the payload, and refers like any other. Rows that repeat the smallest id are all responses. A
    null url is left out. Control characters in urls are percent-encoded. No pages make no archive and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.plans.session import run_folder, settled

SMALLEST = 100
ARCHIVE_BYTES = 1 << 30
PIECE = 1 << 18
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"  # nothing reads the clock

#: Fixed values of the format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    block = b"" if refers_to is not None else HTTP % len(payload) + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", IDENTICAL),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    store, base = open_folder(folder)
    task = TaskContext.get()
    name = f"{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}" if task else uuid.uuid4().hex
    out: BinaryIO | None = None
    path, size, count, number = "", 0, 0, 0

    def finished() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    for batch in batches:
        for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if out is None:
                store.create_dir(base, recursive=True)
                path, size, count = f"{base}/{name}-{number:04d}.warc.gz", 0, 0
                out = store.open_output_stream(path, compression=None)
            member = record(page_id, url, payload, digest, refers_to)
            out.write(member)
            size, count = size + len(member), count + 1
            if size >= archive_bytes:
                yield finished()
                out, number = None, number + 1
    if out is not None:
        yield finished()


def write(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes the archives; returns (path, bytes, records) of each."""
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    large = rows.where(F.octet_length("payload") >= SMALLEST).select("page_id", "digest")
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    linked = rows.join(shared.select("digest", "first"), "digest", "left")
    linked = linked.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))
    manifest = linked.mapInArrow(
        lambda batches: _write(batches, folder, archive_bytes), "path string, bytes long, records long"
    )
    return settled(manifest, "warc-archives")


class Members:
    """A file of gzip members as one stream of bytes, inflated piece by piece."""

    def __init__(self, raw: BinaryIO) -> None:
        self.raw, self.inflate, self.held, self.begun = raw, zlib.decompressobj(31), b"", False

    def _more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.inflate, self.begun = zlib.decompressobj(31), False
        data = data or self.raw.read(PIECE)
        if not data:
            if self.begun:
                raise ValueError("the archive ends inside a record")
            return False
        self.begun = True
        self.held += self.inflate.decompress(data, PIECE)
        return True

    def line(self) -> bytes | None:
        """Up to the next CRLF; None at the end."""
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends inside a line")
                return None
        found, self.held = self.held[:at], self.held[at + 2 :]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """size bytes, piece by piece."""
        while size:
            if not self.held and not self._more():
                raise ValueError(f"the archive ends {size} bytes before its record does")
            piece, self.held = self.held[:size], self.held[size:]
            size -= len(piece)
            if piece:
                yield piece


def read_records(raw: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, payload) of each record in order; the payload of a revisit is empty."""
    stream = Members(raw)
    while (version := stream.line()) is not None:
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = {}
        while line := stream.line():
            name, colon, value = line.decode().partition(":")
            if not colon:
                raise ValueError(f"not a header field: {name[:40]!r}")
            fields[name.strip().lower()] = value.strip()
        block = b"".join(stream.take(int(fields["content-length"])))
        if stream.line() != b"" or stream.line() != b"":
            raise ValueError("a record's block is longer than its Content-Length")
        _verify(fields.get("warc-block-digest"), block)
        payload = block
        if fields["warc-type"] == "response" and fields.get("content-type", "").startswith("application/http"):
            payload = block[block.index(b"\r\n\r\n") + 4 :]
        if fields["warc-type"] != "revisit":
            _verify(fields.get("warc-payload-digest"), payload)
        yield fields, payload


def _verify(digest: str | None, data: bytes) -> None:
    if digest is None:
        return
    kind, _, value = digest.partition(":")
    if hashlib.new(kind, data).hexdigest() != value.lower():
        raise ValueError(f"digest {digest} does not match {len(data)} bytes")


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    store, _ = open_folder(folder)
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    kinds = [types[part.split()[1]] for part in SCHEMA.split(", ")] + ([pa.binary()] if with_payload else [])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [*names, *["payload"] * with_payload]
        )

    for batch in batches:
        for path in batch.column(0).to_pylist():
            with store.open_input_stream(path, compression=None) as raw:
                rows, held = [], 0
                for fields, payload in read_records(raw):
                    digest = fields.get("warc-payload-digest", "").partition(":")[2]
                    size = _number(fields.get("x-payload-length")) if fields["warc-type"] == "revisit" else len(payload)
                    row = (_number(fields.get("x-page-id")), fields.get("warc-target-uri"), fields["warc-type"], size, digest)
                    row += (_number(fields.get("x-refers-to-page")),)
                    rows.append((*row, payload) if with_payload else row)
                    held += len(payload) if with_payload else 1
                    if len(rows) >= 4096 or held >= 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)


def read(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Rows of the archives' records. archives: (path, ...), one task per archive."""
    count = max(1, archives.count())
    schema = SCHEMA + (", payload binary" if with_payload else "")
    dealt = archives.select("path").repartition(count)
    return dealt.mapInArrow(lambda batches: _read(batches, folder, with_payload), schema)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives beside the session's other stored steps."""
    return f"{run_folder(spark)}/warc-{uuid.uuid4().hex[:12]}"
