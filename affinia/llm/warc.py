"""WARC archives: written record by record as gzip members, read back by byte ranges.

Every record is a gzip member of its own, so a reader may begin at any member. Records of one Arrow
batch make a segment of up to ``SEGMENT`` bytes; Spark's text writer commits the segments (its line separator is
an empty gzip member, so that the files are plain sequences of members). A payload of at least
``LEAST`` bytes that other pages repeat is stored once, with the page of the smallest page_id; the
others are ``revisit`` records that refer to it and carry its digest and length.

The reader cuts every file into ranges of ``RANGE`` bytes. A task looks for the gzip magic in its
range, takes a candidate for a member if it inflates to a WARC version line and headers that parse,
and from there reads member after member; it owns the records that start inside its range, also
when they end in a later one, and never looks at bytes before its range.

Defined cases: a null html is an empty payload; a null url is left out; rows without a page_id
are written with the id ``null`` and never referred to; rows that repeat a page_id and payload are
all responses if that page_id is the payload's smallest; an empty table gives no records; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm.common import stage

LEAST = 100
RANGE = 8 << 20
SEGMENT = 4 << 20
LEVEL = 4
READ = 1 << 18
STEP = 1 << 16
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
VERSION = b"WARC/1.1\r\n"
ID = "urn:page:"


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _escaped(value: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A WARC record; one that refers to another has no block of its own."""
    block = payload if refers_to is None else b""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'null' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _escaped(url)))
    if refers_to is not None:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", f"<{ID}{refers_to}>"))
    headers += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; ValueError if it is not a whole one."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("not a WARC header")
        headers[name.decode().strip().lower()] = value.decode().strip()
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("a record is cut short")
    return headers, rest[:length]


def write(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Archives of ``pages`` (page_id, url, html) in ``folder``."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # Only payloads that several rows share; usually few, so the pages need no shuffle.
    shared = stage(
        rows.where(F.octet_length("html") >= least)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first"), "shared-payloads",
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    ready = rows.join(shared, "digest", "left").select(
        "page_id", "url", F.col("html").cast("binary").alias("payload"), "digest", refers.alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(member(record(*row)))
                size += len(held[-1])
                if size >= SEGMENT:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    segments = ready.mapInArrow(run, "value binary")
    (
        segments.select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(folder)
    )


def open_file(path: str):
    """A seekable binary file at a local path or a URI that pyarrow knows (hdfs, s3, gs, ...)."""
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return where.open_input_file(name)


def records_in(file, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of the members that start in [start, end) of an open file."""
    at = _first_member(file, size, start, end)
    if at is None:
        return
    file.seek(at)
    ahead = b""
    while at < end and at < size:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            piece = ahead or file.read(STEP)
            if not piece:
                raise ValueError(f"the member at {at} is cut short")
            out.append(unpacker.decompress(piece))
            ahead = unpacker.unused_data
            at += len(piece) - len(ahead)
        data = b"".join(out)
        if data:  # an empty member separates segments
            yield parse(data)


def _first_member(file, size: int, start: int, end: int) -> int | None:
    """The first validated record member that starts in [start, end)."""
    at, tail = start, b""
    while at < end:
        file.seek(at)
        # Two bytes more, for a magic that starts inside and ends outside.
        window = file.read(min(READ, end - at) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        while found >= 0 and at + found < end:
            if _is_record(file, size, at + found):
                return at + found
            found = window.find(MAGIC, found + 1)
        at += READ
    return None


def _is_record(file, size: int, at: int) -> bool:
    """Whether a member starts with a record's header, which ends where it ends: however long."""
    file.seek(at)
    unpacker, head, rest = zlib.decompressobj(31), bytearray(), b""
    try:
        while True:
            looked = max(0, len(head) - 3)
            if not rest:
                rest = file.read(4096)
                if not rest:
                    return False
            head += unpacker.decompress(rest, READ)
            rest = unpacker.unconsumed_tail
            if not b"WARC/".startswith(head[:5]):
                return False
            if head.find(b"\r\n\r\n", looked) >= 0:
                break
            if unpacker.eof:
                return False
        lines = bytes(head).partition(b"\r\n\r\n")[0].split(b"\r\n")
        return lines[0].startswith(b"WARC/") and all(b":" in x for x in lines[1:]) and any(
            x.lower().startswith(b"content-length:") for x in lines[1:]
        )
    except zlib.error:
        return False


def read(spark: SparkSession, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes, payload_digest."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    count = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1
    step = F.lit(range_bytes).cast("long")
    # A given number of partitions stays as it is; by their few bytes, rows would meet in one task.
    ranges = files.select(
        "path", "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)).alias("start"),
    ).repartition(int(min(count, 100_000)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(path) as file:
                    yield from _batches(records_in(file, size, start, min(size, start + range_bytes)))

    return ranges.mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload binary, "
        "payload_bytes long, payload_digest string"
    )


def _page(uri: str | None) -> int | None:
    name = uri[1:-1].removeprefix(ID) if uri else "null"
    return None if name == "null" else int(name)


def _batches(found: Iterator[tuple[dict[str, str], bytes]]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    rows, size = [], 0
    for headers, block in found:
        kind, noted = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response":
            digest, length = hashlib.sha256(block).hexdigest(), len(block)
            if digest != noted:
                raise ValueError(f"the payload of {headers['warc-record-id']} does not have its digest")
        else:
            digest, length, block = noted, int(headers["warc-payload-length"]), None
        rows.append((
            _page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind,
            _page(headers.get("warc-refers-to")), block, length, digest,
        ))
        size += len(block or b"")
        if size >= SEGMENT or len(rows) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
