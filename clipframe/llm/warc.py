"""WARC archives: one gzip member for each record, and a reader that splits them anywhere."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipframe.llm.common import written
from clipframe.session import new_folder

# Fixed values of the format
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables have none, and a retried task must repeat it

FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
SPLITS_PER_TASK = 16
READ_BYTES = 1 << 20


def filesystem(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path[5:].lstrip("/")
    return FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)


def record(page_id: int | None, url: str | None, html: str | None, kind: str, sha1: str,
           refers_to: int | None) -> bytes:
    payload = (html or "").encode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if kind == "response" else http
    name = "" if page_id is None else str(page_id)
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
             "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(
            c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
            for c in url))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = 3,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages (page_id, url, html)``; returns the files' manifest.

    Of rows with equal payloads of at least ``min_bytes`` the one with the smallest
    ``page_id`` is a response, the others are revisits of it; a repeated smallest id
    is a response each time. A null ``html`` is an empty payload, a null ``url`` has
    no target line. A null ``page_id`` refers to the smallest id of its payload, and
    is a response where there is none. A group of copies of any size is one row of
    an aggregate; the join back splits it. Other columns are not read.

    Files have names of their own for every attempt, and only those in the manifest
    ``(path, size, records)`` count, so a lost or repeated task leaves no records.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html",
                        F.sha1(html.cast("binary")).alias("sha1"),
                        (F.octet_length(html) >= min_bytes).alias("shared"))
    first = rows.filter("shared").groupBy("sha1").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter(
            "n > 1 and refers_to is not null").drop("n")
    rows = rows.join(first, "sha1", "left").select(
        "page_id", "url", "html",
        F.when(F.col("shared") & F.col("refers_to").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("refers_to")), "revisit")
        .otherwise("response").alias("kind"), "sha1", "refers_to")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, path, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "size": size, "records": n}])

        for batch in batches:
            for i in range(batch.num_rows):
                values = [c[i].as_py() for c in batch.columns]
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, out, size, n = f"{folder}/{name}", fs.open_output_stream(
                        f"{root}/{name}", compression=None), 0, 0
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = member.compress(record(*values)) + member.flush()
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(rows.mapInArrow(save, "path string, size bigint, records bigint"), "manifest")


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes
    end: int  # offset of what follows the member


class Source:
    """A file read in pieces; ``at`` gives the bytes from an offset on."""

    def __init__(self, handle, size: int):
        self.handle, self.size = handle, size
        self.start, self.buffer = 0, b""

    def at(self, offset: int) -> bytes:
        if not self.start <= offset < self.start + len(self.buffer):
            self.start = offset
            self.buffer = self.handle.read_at(min(READ_BYTES, self.size - offset), offset)
        return self.buffer[offset - self.start:]


def find_member(source: Source, offset: int, end: int) -> int | None:
    """First offset before ``end`` that has the magic bytes."""
    while offset < end:
        data = source.at(offset)
        found = data.find(MAGIC)
        if found >= 0:
            return offset + found if offset + found < end else None
        if len(data) < len(MAGIC):
            if offset + len(data) >= source.size:
                return None
            source.buffer = b""  # the magic may lie across two reads
            continue
        offset += len(data) - len(MAGIC) + 1
    return None


def read_record(source: Source, offset: int) -> Record | None:
    """The record of the member at ``offset``; None if no member with a WARC head begins there."""
    member, data, at, head = zlib.decompressobj(31), bytearray(), offset, None
    while not member.eof:
        if at >= source.size:
            return None
        piece = source.at(at)
        try:
            data += member.decompress(piece)
        except zlib.error:
            return None
        at += len(piece) - len(member.unused_data)
        if head is None:
            if data[:5] != b"WARC/"[:len(data[:5])]:
                return None
            found = data.find(b"\r\n\r\n")
            if found >= 0:
                head = found
    if head is None:
        return None
    pairs = (line.partition(":") for line in data[:head].decode("utf-8", "replace").split("\r\n")[1:])
    headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
    length = headers.get("content-length", "")
    if not length.isdigit() or len(data) < head + 4 + int(length):
        return None
    return Record(headers, bytes(data[head + 4:head + 4 + int(length)]), at)


def records(source: Source, start: int, end: int) -> Iterator[Record]:
    """The records that begin in ``[start, end)``, wherever they end."""
    offset = start
    while (found := find_member(source, offset, end)) is not None:
        got = read_record(source, found)
        if got is None:
            offset = found + 1
        else:
            yield got
            offset = got.end


def _urn(value: str | None) -> int | None:
    name = (value or "").strip("<>").rpartition(":")[2]
    return int(name) if name.lstrip("-").isdigit() else None


SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
          "record_type string, refers_to bigint, digest_ok boolean")


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = False) -> DataFrame:
    """Records of the files in ``manifest (path, size)``, one task item for each byte range.

    A task looks for gzip magic from the start of its range, takes a candidate for a
    record if it decompresses to a WARC head, and owns the records that begin in its
    range. So any cut gives every record once. ``digest_ok`` tells whether the
    payload of a response has the digest that its head names (null for a revisit,
    whose payload size is that of its HTTP head). ``payload=True`` adds the bytes.
    """
    splits = manifest.selectExpr(
        "path", "size", f"explode(sequence(0L, greatest(size - 1, 0L), {split_bytes}L)) as start")
    count = manifest.selectExpr(f"sum(ceil(size / {split_bytes}))").first()[0]
    count, cores = int(count or 1), manifest.sparkSession.sparkContext.defaultParallelism
    splits = splits.repartition(max(-(-count // SPLITS_PER_TASK), min(count, cores)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                fs, inner = filesystem(split["path"])
                rows, held = [], 0
                with fs.open_input_file(inner) as handle:
                    source = Source(handle, split["size"])
                    stop = min(split["start"] + split_bytes, split["size"])
                    for got in records(source, split["start"], stop):
                        rows.append(row(got))
                        held += len(got.block) if payload else 0
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def row(got: Record) -> dict:
        head, _, body = got.block.partition(b"\r\n\r\n")
        kind = got.headers.get("warc-type")
        named = got.headers.get("warc-payload-digest", "").removeprefix("sha1:")
        size, ok = len(body), None
        if kind == "response":
            ok = base64.b32encode(hashlib.sha1(body).digest()).decode() == named
        else:
            for line in head.split(b"\r\n"):
                if line.lower().startswith(b"content-length:"):
                    size = int(line.partition(b":")[2])
        out = {"page_id": _urn(got.headers.get("warc-record-id")),
               "url": got.headers.get("warc-target-uri"), "payload_bytes": size,
               "payload_digest": named, "record_type": kind,
               "refers_to": _urn(got.headers.get("warc-refers-to")), "digest_ok": ok}
        return {**out, "payload": body} if payload else out

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("record_type", pa.string()),
              ("refers_to", pa.int64()), ("digest_ok", pa.bool_())]
    schema = pa.schema([*fields, ("payload", pa.binary())] if payload else fields)
    return splits.mapInArrow(scan, SCHEMA + (", payload binary" if payload else ""))


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read(write(pages, folder, min_bytes))
