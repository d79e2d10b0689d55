"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of about ``FRAME_BYTES`` of records, followed by a seek table in a
skippable frame (the published seekable format), so any Zstandard tool reads the whole file and a reader of one record
decompresses one frame.  Writing returns an index, one row per record: bundle, frame and the record's offset inside its frame.

Tasks write bundles under names of their own and Spark commits the index; a bundle that no committed index row names was left by
a lost task and is never read.  Files go to any store that pyarrow's file systems reach from a URI.

Payloads are compared by SHA-1.  Of equal payloads the row with the smallest id is the response, the others revisit it.

Defined cases: a NULL payload is empty; a NULL id counts as the largest id; rows that repeat id and payload are all responses if
that id is the smallest; a NULL url leaves the target header out, control characters and blanks in it are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, functions as F

from freshet.llm.common import partitions
from freshet.operators.skew import join_counted
from freshet.session import scratch_path, stored_table

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 512 << 20        # compressed
LEVEL = 3
LEAST_REVISIT = 0        # bytes from which equal payloads are revisits
LAST_ID = 2**63 - 1
# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BundleWriter:
    """Frames of records into one file, the seek table at its end."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.size = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset inside the frame) of the record."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        at = (len(self.frames), self.size)
        self.open.append(record)
        self.size += len(record)
        return at

    def flush(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.open, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.frames), 0, SEEKABLE))
        self.stream.close()


class BundleReader:
    """Frames of a bundle, found by its seek table."""

    def __init__(self, file):
        self.file = file
        size = file.size() if hasattr(file, "size") else len(file.getbuffer())
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        width = 12 if flags & 0x80 else 8
        file.seek(size - 9 - width * count)
        table, at = file.read(width * count), 0
        self.frames = []
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, i * width)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=max(1, plain))


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The bytes of one WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """(headers, payload length as the HTTP header states it, payload in the record) of one WARC record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    return headers, stated, payload


def _page(value: str) -> int | None:
    inner = value.removeprefix("<urn:page:").removesuffix(">")
    return None if inner == "None" else int(inner)


_INDEX = pa.schema([("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def _write(root: str, date: str, frame_bytes: int, bundle_bytes: int):
    def run(batches):
        files, folder = pafs.FileSystem.from_uri(root)
        files.create_dir(folder, recursive=True)
        name = writer = None
        held: list[list] = [[], [], [], [], []]

        def index() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, t.type) for c, t in zip(held, _INDEX)], schema=_INDEX)
            for c in held:
                c.clear()
            return out

        for batch in batches:
            for page, url, html, sha1, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(files.open_output_stream(f"{folder}/{name}", compression=None), frame_bytes)
                raw = record(page, url, html.encode(), base64.b32encode(bytes.fromhex(sha1)).decode(), first, revisit, date)
                frame, offset = writer.add(raw)
                for c, v in zip(held, (f"<urn:page:{page}>", name, frame, offset, len(raw))):
                    c.append(v)
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            if writer is not None:
                writer.flush()        # what the index names from here on is on its way to the file
            yield index()
        if writer is not None:
            writer.close()
    return run


def write_bundles(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_REVISIT,
                  frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str | None = None) -> DataFrame:
    """Write one record per row below ``root``; the index: record_id, bundle, frame, offset (inside the frame) and length."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    source = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("html"),
                          F.sha1(F.encode(payload, "utf-8")).alias("sha1"))
    same = source.filter(F.octet_length("html") >= least).groupBy("sha1").agg(
        F.min(F.coalesce("page", F.lit(LAST_ID))).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    same = stored_table(same, "payloads")
    total = same.agg(F.sum("rows")).first()[0] or 0
    known = join_counted(source, same, ["sha1"], ["page", "url"], "rows", total)
    revisit = F.coalesce(F.col("first") != F.coalesce("page", F.lit(LAST_ID)), F.lit(False)) & (F.octet_length("html") >= least)
    rows = known.select("page", "url", "html", "sha1", F.when(F.col("first") != LAST_ID, F.col("first")).alias("first"), revisit.alias("revisit"))
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    written = rows.mapInArrow(_write(root, date, frame_bytes, bundle_bytes), "record_id string, bundle string, frame int, offset long, length long")
    return stored_table(written, "warc-index")


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])


def _fetch(root: str, with_payload: bool):
    def found(batches) -> Iterator[tuple]:
        files, folder = pafs.FileSystem.from_uri(root)
        bundle = frame = reader = plain = None
        for batch in batches:
            for b, f, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bundle:
                    reader, bundle, frame = BundleReader(files.open_input_file(f"{folder}/{b}")), b, None
                if f != frame:
                    plain, frame = reader.frame(f), f
                headers, stated, payload = parse(plain[offset:offset + length])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = headers["WARC-Type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"record {headers['WARC-Record-ID']} of {b} does not have its stated digest")
                refers = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
                yield _page(headers["WARC-Record-ID"]), stated, digest, kind, refers, headers.get("WARC-Target-URI"), payload.decode() if with_payload and kind == "response" else None

    def run(batches):
        rows, size = [], 0
        for row in found(batches):
            rows.append(row)
            size += 200 + len(row[6] or "")
            if size > 8 << 20:
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), _READ)], schema=_READ)
                rows, size = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), _READ)], schema=_READ)
    return run


def fetch(index: DataFrame, root: str, wanted: DataFrame | None = None, with_payload: bool = True) -> DataFrame:
    """The records of the index, or those whose record_id is in ``wanted``; each frame is read and decompressed once.

    Payloads of responses are checked against their digests.
    """
    rows = index if wanted is None else index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    placed = rows.select("bundle", "frame", "offset", "length").repartition(partitions(index.sparkSession), "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return placed.mapInArrow(_fetch(root, with_payload), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string")


def archive_folder(spark) -> str:
    """A fresh folder for bundles in the shared folder, as a URI."""
    path = scratch_path(spark, "warc")
    return path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{path}"


