"""WARC records in seekable Zstandard bundles (operator 5).

Writing: equal payloads of a minimum size are found by their digest (a partial
aggregate; the few repeated digests are joined back, so a payload that a third
of all pages share stays spread over all tasks). Every task then appends WARC
records to a bundle of its own: records are grouped into frames, each an
independent Zstandard frame, and a skippable frame with the seek table closes
the file. An index row maps each record's identifier to its bundle, frame,
offset in the decompressed frame, and length.

Reading: a task takes index rows, finds the frame by the bundle's footer, and
decompresses that frame alone.

A bundle's name is unique to the attempt that wrote it, and only the committed
index names bundles; files of lost or repeated attempts are never read. Files
go through Arrow's file systems into the shared folder (``file``, ``hdfs``,
``s3``, ``gs``).

Defined results: null html is an empty payload; a null URL an empty target; a
null page_id never refers or is referred to; of repeated rows with the largest
page_id of a payload each is a response; an empty table gives no bundle and no
rows; a payload larger than a frame gets a frame of its own; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage, slices, table

# Fixed values of the seekable format and of WARC/1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
MAX_FRAMES = 0x8000000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
INDEX = "record_id string, bundle string, frame long, offset long, length long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class BundleWriter:
    """Appends records to frames, and frames to one file."""

    def __init__(self, folder: str, frame_bytes: int):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, path = file_system(self.uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        self.frame_bytes, self.pending, self.held, self.written = frame_bytes, [], 0, 0
        self.table: list[tuple[int, int]] = []
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, offset in it, length) of the record."""
        if self.held and self.held + len(record) > self.frame_bytes:
            self.flush()
        place = (len(self.table), self.held, len(record))
        self.pending.append(record)
        self.held += len(record)
        return place

    def flush(self) -> None:
        if self.held:
            frame = self.packer.compress(b"".join(self.pending))
            self.out.write(frame)
            self.table.append((len(frame), self.held))
            self.written += len(frame)
            self.pending, self.held = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Frames of one bundle by number; keeps the last one."""

    def __init__(self, uri: str):
        files, path = file_system(uri)
        self.uri, self.file = uri, files.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or count >= MAX_FRAMES:
            raise ValueError(f"{uri} has no seek table")
        step = 12 if flags & 0x80 else 8
        raw = self.file.read_at(step * count, size - 9 - step * count)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", raw, step * k)
            self.frames.append((at, packed, plain))
            at += packed
        self.last: tuple[int, bytes] = (-1, b"")

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if self.last[0] != frame:
            at, packed, plain = self.frames[frame]
            self.last = (frame, zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain))
        return self.last[1][offset : offset + length]


def record_bytes(record_id: str, url: str | None, date: str, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """A WARC record; a revisit has the HTTP head and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = http if refers_to else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n") if ": " in line)


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def record_name(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def write_bundles(pages: DataFrame, folder: str, stage: Stage, min_revisit: int = 1000, date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write bundles under ``folder`` and return the staged index of their records."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    repeats = own.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where(F.col("n") > 1).select("digest", "kept")
    repeats = stage.write(repeats, "repeats")
    joined = own.join(repeats, "digest", "left")
    refers = F.when(F.col("page_id") != F.col("kept"), F.col("kept"))
    records = joined.select("page_id", "url", "digest", "size", refers.alias("refers_to"), F.when(refers.isNull(), F.col("html")).otherwise("").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in slices(batches, "html"):
            rows: list[tuple] = []
            for page, url, digest, size, refers_to, payload in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "refers_to", "html")), strict=True):
                if bundle is None:
                    bundle = BundleWriter(folder, frame_bytes)
                other = None if refers_to is None else record_name(refers_to)
                record = record_bytes(record_name(page), url, date, payload.encode("utf-8", "surrogatepass"), size, digest, other)
                rows.append((record_name(page), bundle.uri, *bundle.add(record)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return stage.write(records.mapInArrow(run, INDEX), "index")


def read_records(index: DataFrame) -> DataFrame:
    """(record_id, record_type, target, payload_bytes, payload_digest, refers_to, payload) of each index row, from the bundles."""
    names = ["record_id", "record_type", "target", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            rows, held = [], 0
            for bundle, frame, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if reader is None or reader.uri != bundle:
                    reader = BundleReader(bundle)
                warc, http, payload = parse(reader.record(frame, offset, length))
                record_id, revisit = warc["WARC-Record-ID"][1:-1], warc["WARC-Type"] == "revisit"
                digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{record_id} in {bundle} does not have its digest")
                size = int(http["Content-Length"]) if revisit else len(payload)
                rows.append((record_id, warc["WARC-Type"], warc.get("WARC-Target-URI", ""), size, digest, warc["WARC-Refers-To"][1:-1] if revisit else None, payload))
                held += len(payload)
                if held >= FRAME_BYTES * 8:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return index.mapInArrow(run, "record_id string, record_type string, target string, payload_bytes long, payload_digest string, refers_to string, payload binary")


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "warc")
    records = read_records(write_bundles(table(spark, sf_dir, "pages"), f"{stage.folder}/bundles", stage))
    number = lambda c: F.substring(F.col(c), len(record_name(None)) + 1, 20).try_cast("long")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


ORACLE = """
WITH own AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), kept AS (
  SELECT payload_digest, max(page_id) AS kept FROM own WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept IS NULL OR kept = page_id OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM own LEFT JOIN kept USING (payload_digest)
"""
