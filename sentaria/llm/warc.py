"""WARC bundles in the seekable Zstandard format.

A bundle is a row of independent Zstandard frames, each with a few whole records, and a
seek table in a closing skippable frame, which plain Zstandard readers pass over. The
manifest maps a record id to its bundle, frame and place inside the frame, so that one
record costs one small range read and the decompression of one frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import stored, table, width
from sentaria.plans.sizing import scratch_path

# Fixed values of the seekable format and of the skippable frame that carries its table.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Uncompressed bytes after which a frame is closed, compressed bytes after which a bundle is.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
LEVEL = 3
#: Equal payloads under this size are all written in full.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"

MANIFEST = (
    "page_id bigint, record_id string, bundle string, frame int, frame_offset bigint, frame_bytes bigint, "
    "place bigint, record_bytes bigint"
)
RECORDS = (
    "page_id bigint, record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _one_line(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def format_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, target: int | None, revisit: bool
) -> bytes:
    """One record. A revisit has no payload but names its digest, size and the page it repeats."""
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(target, digest)}")
        head.append(f"X-Refers-To-Page-ID: {target}")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse_records(block: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(place, headers, body)`` of every record of an uncompressed frame."""
    at = 0
    while at < len(block):
        end = block.index(b"\r\n\r\n", at)
        lines = block[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield at, headers, block[start:stop]
        at = stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for ``(compressed, uncompressed)`` sizes."""
    entries = b"".join(struct.pack("<II", c, d) for c, d in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """``(offset, compressed, uncompressed)`` of each frame, from the end of an open file."""
    file.seek(size - 9)
    n, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if descriptor & 0x80 else 8
    file.seek(size - 9 - n * entry)
    raw = file.read(n * entry)
    frames, at = [], 0
    for i in range(n):
        compressed, plain = struct.unpack_from("<II", raw, i * entry)
        frames.append((at, compressed, plain))
        at += compressed
    return frames


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: a plain path or a URI that pyarrow knows."""
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


@dataclass
class BundleWriter:
    """Writes records into bundles of a folder and tells where each record went.

    A bundle is written under a name of its own and only named in the rows of an attempt
    that succeeds, so a repeated task leaves an unused file and nothing worse.
    """

    folder: str
    frame_bytes: int = FRAME_BYTES
    bundle_bytes: int = BUNDLE_BYTES

    def __post_init__(self):
        self._fs, self._path = open_folder(self.folder)
        self._packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._file = None
        self._open: list[tuple] = []
        self._block = bytearray()

    def add(self, page_id: int | None, record: bytes, name: str) -> list[tuple]:
        """Manifest rows of the frame that this record closes, or none."""
        self._open.append((page_id, name, len(self._block), len(record)))
        self._block += record
        return self._close_frame() if len(self._block) >= self.frame_bytes else []

    def _close_frame(self) -> list[tuple]:
        if not self._open:
            return []
        if self._file is None:
            self._name = f"{uuid.uuid4().hex}.warc.zst"
            self._fs.create_dir(self._path, recursive=True)
            self._file = self._fs.open_output_stream(f"{self._path}/{self._name}", compression=None)
            self._frames, self._at = [], 0
        packed = self._packer.compress(bytes(self._block))
        self._file.write(packed)
        rows = [
            (page_id, name, self._name, len(self._frames), self._at, len(packed), place, size)
            for page_id, name, place, size in self._open
        ]
        self._frames.append((len(packed), len(self._block)))
        self._at += len(packed)
        self._open, self._block = [], bytearray()
        if self._at >= self.bundle_bytes:
            self._close_bundle()
        return rows

    def _close_bundle(self) -> None:
        if self._file is not None:
            self._file.write(seek_table(self._frames))
            self._file.close()
            self._file = None

    def close(self) -> list[tuple]:
        rows = self._close_frame()
        self._close_bundle()
        return rows


def _arrow_schema(spark_schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.strip().split(" ") for c in spark_schema.split(","))])


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def revisit_targets(pages: DataFrame) -> DataFrame:
    """``(digest, target)``: the largest page id of each payload that occurs again and is long enough."""
    rows = pages.select("page_id", F.sha1(_payload()).alias("digest"), F.length(_payload()).alias("n"))
    return (
        rows.filter(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("target"), F.min("page_id").alias("_least"))
        .filter("_least < target OR target IS NULL")
        .select("digest", "target")
    )


def _payload():
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write one record for each row of ``pages`` below ``folder`` and return the stored manifest.

    Null html is an empty payload, a null url leaves its header out. Of equal payloads of at
    least 1,000 bytes the largest page id gets the response and every smaller (or null) id
    a revisit; rows that repeat that largest id are responses, too, and so are payloads
    of null ids alone. An empty table writes no bundle. The folder must be reachable from
    every executor. Other columns are ignored.
    """
    schema = _arrow_schema(MANIFEST)
    # stored first: a small list is then broadcast by its real size, a long one is joined with split skew
    targets = stored(revisit_targets(pages), "revisit-targets")
    rows = (
        pages.select("page_id", "url", _payload().alias("payload"))
        .withColumn("digest", F.sha1("payload"))
        .join(targets, "digest", "left")
        .select("page_id", "url", "payload", "digest", "target")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes)
        for batch in batches:
            out: list[tuple] = []
            for page_id, url, payload, digest, target in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = target is not None and len(payload) >= REVISIT_BYTES and page_id != target
                record = format_record(page_id, url, payload, digest, target, revisit)
                out += writer.add(page_id, record, record_id(page_id, digest))
            yield _as_batch(out, schema)
        yield _as_batch(writer.close(), schema)

    return stored(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_frames(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of all frames that the manifest names, each frame read once.

    ``payload_bytes`` and ``payload_digest`` of a response are measured on what was read;
    those of a revisit are the ones its headers carry.
    """
    frames = stored(manifest.select("bundle", "frame", "frame_offset", "frame_bytes").distinct(), "warc-frames")
    # a row of few bytes stands for a frame of many: tasks are dealt by what the frames hold
    total = frames.agg(F.coalesce(F.sum("frame_bytes"), F.lit(0)).alias("n")).first()["n"]
    frames = frames.repartition(width(manifest.sparkSession, total), "bundle", "frame")
    schema = _arrow_schema(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        unpacker = zstandard.ZstdDecompressor()
        name, file = None, None
        for batch in batches:
            for bundle, _, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    if file is not None:
                        file.close()
                    name, file = bundle, fs.open_input_file(f"{path}/{bundle}")
                block = unpacker.decompress(file.read_at(size, offset))
                yield _as_batch([_read(h, body, with_payload) for _, h, body in parse_records(block)], schema)
        if file is not None:
            file.close()

    return frames.sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORDS)


def _read(headers: dict[str, str], body: bytes, with_payload: bool) -> tuple:
    kind = headers["WARC-Type"]
    if kind == "response":
        n, digest = len(body), hashlib.sha1(body).hexdigest()
    else:
        n, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(headers[name]) if name in headers else None
    return (
        number("X-Page-ID"), headers["WARC-Record-ID"], headers.get("WARC-Target-URI"), n, digest, kind,
        number("X-Refers-To-Page-ID"), body if with_payload else None,
    )


def fetch(spark: SparkSession, manifest: DataFrame, folder: str, page_ids: list[int]) -> DataFrame:
    """The records of some pages, by reading only their frames."""
    wanted = manifest.filter(F.col("page_id").isin(page_ids))
    names = wanted.select("record_id").distinct()
    return read_frames(wanted, folder, with_payload=True).join(names, "record_id", "left_semi")


def op6_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc-bundles")
    manifest = write_bundles(table(spark, sf_dir, "pages"), folder)
    return read_frames(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
