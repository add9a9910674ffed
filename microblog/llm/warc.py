"""WARC archives: one gzip member per record, written and read sequentially.

``write`` stores a record per page. Pages with equal payloads of at least
``MIN_REVISIT_BYTES`` bytes are stored once: the one with the largest page_id
as ``response``, the others as ``revisit`` that refers to it. ``read`` goes
through an archive from its start: a member's bytes are inflated piece by
piece, its header ends at the first empty line, Content-Length frames the
block, and the digests of block and payload are computed again and compared.
Memory does not depend on the archive's size.

Definitions: null html is the empty payload; a null url is written without a
target; a page with a null id is never referred to (it revisits the largest
non-null id of its payload, or is a response if there is none); rows that
share the largest id of their payload are all responses; other columns are not
read. A broken digest, length or member raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, column, materialise, spread
from .files import new_file, open_store

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"  # of the crawl: a parameter, so that archives do not depend on the clock
# The revisit profile and media type that the format names.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record_id(page_id: int | None, sha1: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1.hex()}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member."""
    sha1 = hashlib.sha1(payload).digest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, sha1)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(url.split())))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha1)), ("X-Refers-To-Page", str(refers_to))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", _digest(sha1)), ("WARC-Block-Digest", _digest(hashlib.sha1(block).digest())), ("Content-Type", HTTP), ("Content-Length", str(len(block)))]
    header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(header.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): which page each one revisits. Payload
    digests are counted with a partial aggregate; only digests that repeat take
    part in the join, whose skewed keys Spark splits."""
    body = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", body.alias("html"))
    pages = pages.withColumn("sha1", F.when(F.octet_length("html") >= MIN_REVISIT_BYTES, F.sha1(F.col("html").cast("binary"))))
    kept = (pages.where("sha1 is not null").groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
            .where("n > 1 and newest is not null").select("sha1", "newest"))
    return pages.join(kept, "sha1", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("newest")), None).otherwise(F.col("newest")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, date: str = DATE) -> DataFrame:
    """Write the archives; returns (archive, bytes, records), one row each."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    schema = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = blocks(batches, "html")
        b = next(cut, None)
        while b is not None:
            name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
            size = n = 0
            with new_file(name) as f:
                while b is not None and size < ARCHIVE_BYTES:
                    for page_id, url, html, refers_to in zip(*(column(b, c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                        member = record(page_id, url, html.encode(), refers_to, date)
                        f.write(member)
                        size += len(member)
                        n += 1
                    b = next(cut, None)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((name, size, n), schema.types)], schema=schema)

    return materialise(plan(pages).mapInArrow(run, "archive string, bytes bigint, records bigint"), "archives")


class _Member:
    """The inflated bytes of one gzip member, on demand."""

    def __init__(self, source, rest: bytes):
        self._source, self._pending = source, rest
        self._inflate = zlib.decompressobj(31)
        self._out = bytearray()

    def _more(self) -> bool:
        """Inflate a little more; False at the member's end."""
        if self._inflate.eof:
            return False
        data = self._inflate.unconsumed_tail or self._pending or self._source.read(READ_BYTES)
        if not self._inflate.unconsumed_tail:
            self._pending = b""
        if not data:
            raise ValueError("the archive ends inside a member")
        self._out += self._inflate.decompress(data, READ_BYTES)
        return True

    def line(self) -> bytes:
        while (at := self._out.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a header line has no end")
        got = bytes(self._out[:at])
        del self._out[:at + 2]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        """n bytes, in pieces."""
        while n:
            if not self._out and not self._more():
                raise ValueError("a block is shorter than its Content-Length")
            got = bytes(self._out[:n])
            del self._out[:n]
            n -= len(got)
            if got:
                yield got

    def finish(self) -> bytes:
        """What follows the block; then the bytes of the next member."""
        while self._more():
            pass
        if bytes(self._out) != b"\r\n\r\n":
            raise ValueError("a record does not end after its block")
        return self._inflate.unused_data + self._pending


def records(source) -> Iterator[dict]:
    """The records of an archive stream, in order, digests verified. A record:
    its header fields by lower-case name, ``payload_bytes``, ``payload_sha1``
    (hex) and ``payload`` (None for a revisit)."""
    rest = b""
    while rest or (rest := source.read(READ_BYTES)):
        member = _Member(source, rest)
        if not member.line().startswith(b"WARC/"):
            raise ValueError("no record starts here")
        fields = {}
        while line := member.line():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        whole, body, head = hashlib.sha1(), hashlib.sha1(), b""
        parts: list[bytes] | None = None
        for piece in member.take(int(fields["content-length"])):
            whole.update(piece)
            if parts is None:
                head += piece
                at = head.find(b"\r\n\r\n")
                if at < 0:
                    continue
                parts, piece, head = [], head[at + 4:], head[:at]
            body.update(piece)
            parts.append(piece)
        rest = member.finish()
        if _digest(whole.digest()) != fields["warc-block-digest"]:
            raise ValueError(f"{fields.get('warc-record-id')}: the block's digest differs")
        size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        sha1 = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
        payload = b"".join(parts or ())
        if fields["warc-type"] == "response" and (body.digest() != sha1 or len(payload) != size):
            raise ValueError(f"{fields.get('warc-record-id')}: the payload's digest or length differs")
        yield fields | {"payload_bytes": size, "payload_sha1": sha1.hex(), "payload": payload if fields["warc-type"] == "response" else None}


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to and,
    if asked for, payload): a row per record of the archives, each archive read
    by one task from its start."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields + [("payload", pa.binary())] * with_payload)
    ddl = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

        for name in (x for b in batches for x in column(b, "archive").to_pylist()):
            store, path = open_store(name)
            rows, size = [], 0
            with store.open_input_stream(path, compression=None) as f:
                for r in records(f):
                    page, ref = r.get("x-page-id"), r.get("x-refers-to-page")
                    row = (page and int(page), r.get("warc-target-uri"), r["payload_bytes"], r["payload_sha1"], r["warc-type"], ref and int(ref))
                    rows.append(row + (r["payload"],) * with_payload)
                    size += r["payload_bytes"] if with_payload else 64
                    if size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    todo = spread(archives.select("archive"), "archive")
    return todo.mapInArrow(run, ddl)
