"""WARC records in seekable Zstandard bundles.

Records are packed into frames of about a megabyte that decompress on their own.  A
bundle ends with a seek table: a skippable frame that lists every frame's two sizes,
so that a record is found from its frame number and its offset in the frame without
reading what lies before.  Payloads seen before become revisit records.

Tasks write bundles under names of their own attempt and return the index rows; only
index rows of tasks that Spark commits count, so a lost or repeated attempt leaves at
most a file that nothing refers to.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payloads of this size are stored once.
LEAST_SHARED = 1000
#: Bytes of records per frame and of frames per bundle, at which the next one begins.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 6
DATE = "2020-01-01T00:00:00Z"
#: Up to so many repeated payloads go to every task (about 20 MB), else by shuffle.
BROADCAST_PAYLOADS = 100_000

#: The published seekable format's magic numbers, fixed values.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

_INDEX = "page_id long, record_id string, record_type string, bundle string, frame int, start long, length long"


def decide(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload, bytes, digest, record_type and refers_to of every page.

    Of pages with equal payloads of at least ``least`` bytes those with the largest
    page_id are responses, the others revisit it.  Digests are SHA-1 in lower-case hex.
    A null html has an empty payload; a null page_id is never referred to, and a group
    without any page_id consists of responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    shared = (
        rows.where(F.col("bytes") >= least).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    if shared.count() <= BROADCAST_PAYLOADS:
        shared = F.broadcast(shared)
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return (
        rows.join(shared, ["digest", "bytes"], "left")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("keeper")))
        .select("page_id", "url", "payload", "bytes", "digest", "record_type", "refers_to")
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}:{digest}'.encode()).hexdigest())}>"


def _field(value: str) -> str:
    """A header value without blanks and control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record(row: dict, date: str = DATE) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    response = row["record_type"] == "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http + row["payload"] if response else http
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["digest"])),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(row["bytes"])),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _field(row["url"])))
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    if not response:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(row["refers_to"], row["digest"])),
            ("X-Refers-To-Page", str(row["refers_to"])),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The row behind one record; the digest of a response is that of its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    payload = block.partition(b"\r\n\r\n")[2]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and hashlib.sha1(payload).hexdigest() != stated:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "payload_bytes": len(payload) if response else number("X-Payload-Length"),
        "payload_digest": stated,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload if response else None,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class Writer:
    """Bundles below a folder, one after the other as they fill."""

    def __init__(self, folder: str, name: str, level: int = LEVEL) -> None:
        self.files, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.folder, self.name, self.level = folder, name, level
        self.files.create_dir(self.root, recursive=True)
        self.turn, self.out = 0, None

    def add(self, data: bytes) -> tuple[str, int, int, int]:
        """(bundle, frame, offset in the frame, length) of a record."""
        if self.out is None:
            self.bundle = f"{self.name}-{self.turn}.warc.zst"
            self.out = self.files.open_output_stream(f"{self.root}/{self.bundle}", compression=None)
            self.frames, self.held, self.size = [], [], 0
        place = (f"{self.folder}/{self.bundle}", len(self.frames), self.size, len(data))
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self._frame()
            if sum(c for c, _ in self.frames) >= BUNDLE_BYTES:
                self.close()
        return place

    def _frame(self) -> None:
        if self.held:
            packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.held, self.size = [], 0

    def close(self) -> None:
        if self.out is not None:
            self._frame()
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out, self.turn = None, self.turn + 1


class Reader:
    """Frames of one bundle by number."""

    def __init__(self, bundle: str) -> None:
        files, path = pyarrow.fs.FileSystem.from_uri(bundle)
        self.file = files.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{bundle} has no seek table")
        width = 12 if flags & 0x80 else 8
        self.file.seek(size - 9 - count * width)
        table = self.file.read(count * width)
        self.places, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, k * width)
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.places[k]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer = Writer(folder, f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}")
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                found.append((row["page_id"], record_id(row["page_id"], row["digest"]), row["record_type"], *writer.add(record(row, date))))
            columns = list(zip(*found, strict=True)) if found else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            names = ["page_id", "record_id", "record_type", "bundle", "frame", "start", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        writer.close()

    return run


def write_bundles(pages: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Index rows of all records, one per page; computing them writes the bundles.

    page_id, record_id, record_type, bundle, frame, start, length.  Store the result
    before reading it twice.  Pages stay in the partitions they are read in; repeated
    rows give repeated records; an empty table gives none; other columns are ignored.
    Frames hold a record whole, so the largest page bounds a task's memory.
    """
    return decide(pages).mapInArrow(_write(folder, date), _INDEX)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, reader, data = (None, None), None, b""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["bundle"] != at[0]:
                reader = Reader(row["bundle"])
            if (row["bundle"], row["frame"]) != at:
                at = (row["bundle"], row["frame"])
                data = reader.frame(row["frame"])
            rows.append(parse(data[row["start"] : row["start"] + row["length"]]))
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def read_bundles(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records.

    Each record is read through its bundle's seek table and parsed; a damaged payload
    stops the job.  Records of one frame are read together, the frame once.
    """
    together = index.select("bundle", "frame", "start", "length").repartition("bundle", "frame")
    return together.sortWithinPartitions("bundle", "frame", "start").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
