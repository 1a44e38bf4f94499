"""WARC records in seekable Zstandard bundles.

Records are packed into frames that decompress independently; a bundle ends
with the seek table of the Zstandard seekable format (a skippable frame with
the sizes of all frames and a footer). An index maps a record identifier to
(frame, offset inside the decompressed frame, length), so one record costs the
footer and one frame.

Bundles are rows of a Parquet table (``bundle``, ``records``, ``raw_bytes``,
``data``, ``index``): Spark's commit protocol keeps exactly one attempt of each
task, on any store Spark can write, and a lost executor leaves nothing behind.
``data`` is a complete ``.warc.zst`` file; ``export`` puts it in a folder.

Cases: a null payload is the empty payload; a row without identifier, or with a
payload of fewer than ``min_bytes`` bytes, is a response; rows that repeat one
identifier and payload have the same record type; a null URL is left out; other
columns of the input take no part; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.storage import stored

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
RECORD_DATE = "2024-01-01T00:00:00Z"

INDEX = "array<struct<record_id: string, frame: int, offset: long, length: long>>"
BUNDLES = f"bundle string, records long, raw_bytes long, data binary, index {INDEX}"
INDEX_TYPE = pa.list_(
    pa.struct(
        [("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
    )
)


def record_id(page_id: int | None) -> str:
    return "urn:page:" + ("none" if page_id is None else str(page_id))


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None
) -> bytes:
    """One WARC/1.1 record. A revisit holds no payload but names the response that does."""
    kept = payload if response is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if response is not None:
        lines.append(f"WARC-Refers-To: <{record_id(response)}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(kept)}", "", ""]
    return "\r\n".join(lines).encode() + kept + b"\r\n\r\n"


def parsed_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


class Bundle:
    """Records appended to independent frames, closed by the seek table."""

    def __init__(self) -> None:
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.raw_bytes = 0
        self.index: list[dict] = []

    def add(self, identifier: str, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > FRAME_BYTES:
            self.close_frame()
        self.index.append(
            {
                "record_id": identifier,
                "frame": len(self.frames),
                "offset": self.open_bytes,
                "length": len(record),
            }
        )
        self.open.append(record)
        self.open_bytes += len(record)
        self.raw_bytes += len(record)

    def close_frame(self) -> None:
        frame = self.compressor.compress(b"".join(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), self.open_bytes))
        self.open, self.open_bytes = [], 0

    def finished(self) -> bytes:
        if self.open:
            self.close_frame()
        entries = b"".join(struct.pack("<II", *size) for size in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        skippable = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer))
        return b"".join(self.frames) + skippable + entries + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of every frame, from the footer."""
    count, _, magic = struct.unpack("<IBI", data[-FOOTER_BYTES:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    entries = data[-FOOTER_BYTES - 8 * count : -FOOTER_BYTES]
    frames, start = [], 0
    for packed, raw in struct.iter_unpack("<II", entries):
        frames.append((start, packed, raw))
        start += packed
    return frames


def frame_bytes(data: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, raw = frame
    return zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=raw)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    made, bundle = 0, Bundle()

    def row() -> pa.RecordBatch:
        data = bundle.finished()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"bundle-{task:06d}-{made:06d}"]),
                pa.array([len(bundle.index)], pa.int64()),
                pa.array([bundle.raw_bytes], pa.int64()),
                pa.array([data], pa.binary()),
                pa.array([bundle.index], INDEX_TYPE),
            ],
            names=["bundle", "records", "raw_bytes", "data", "index"],
        )

    for batch in batches:
        for page in batch.to_pylist():
            record = record_bytes(
                page["page_id"], page["url"], page["payload"], page["digest"], page["response"]
            )
            bundle.add(record_id(page["page_id"]), record)
            if bundle.raw_bytes >= BUNDLE_BYTES:
                yield row()
                made, bundle = made + 1, Bundle()
    if bundle.index:
        yield row()


def with_responses(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 1000
) -> DataFrame:
    """(page_id, url, payload, digest, response): ``response`` is null for a response.

    Only (identifier, digest, size) is shuffled to find equal payloads, reduced
    before the shuffle; the payloads then meet the revisits on (identifier,
    digest), a key that no group of copies makes hot.
    """
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), raw.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    keys = records.select("page_id", "digest", F.octet_length("payload").alias("size")).where(
        (F.col("size") >= min_bytes) & F.col("page_id").isNotNull()
    )
    groups = (
        keys.groupBy("digest", "size")
        .agg(F.max("page_id").alias("response"), F.min("page_id").alias("least"))
        .where("least < response")
        .drop("least")
    )
    # Stored, so that the join on the commonest page is one of plain shuffles, which adaptive execution splits.
    groups = stored(groups, "repeated_payloads")
    revisits = (
        keys.join(groups, ["digest", "size"])
        .where("page_id < response")
        .groupBy("page_id", "digest")
        .agg(F.max("response").alias("response"))
    )
    return records.join(stored(revisits, "revisits"), ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, **options) -> DataFrame:
    """The archive of ``pages``, stored in the shared folder, as a table of bundles."""
    records = with_responses(pages, **options).select("page_id", "url", "payload", "digest", "response")
    return stored(records.mapInArrow(_packed, BUNDLES), "archive")


RECORDS = "record_id string, record_type string, refers_to string, digest string, payload_bytes long"


def _rows(records: list[tuple[dict[str, str], bytes]], with_payload: bool) -> pa.RecordBatch:
    for fields, payload in records:
        said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != said:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = [fields.get("WARC-Refers-To") for fields, _ in records]
    columns = {
        "record_id": pa.array([fields["WARC-Record-ID"][1:-1] for fields, _ in records], pa.string()),
        "record_type": pa.array([fields["WARC-Type"] for fields, _ in records], pa.string()),
        "refers_to": pa.array([r and r[1:-1] for r in refers], pa.string()),
        "digest": pa.array(
            [fields["WARC-Payload-Digest"].removeprefix("sha1:") for fields, _ in records], pa.string()
        ),
        "payload_bytes": pa.array([int(fields["X-Payload-Length"]) for fields, _ in records], pa.int64()),
    }
    if with_payload:
        columns["payload"] = pa.array([payload for _, payload in records], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def read_archives(bundles: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records, frame by frame; a response whose payload misses its digest is an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                frames = seek_table(data)
                by_frame: dict[int, list[dict]] = {}
                for entry in index:
                    by_frame.setdefault(entry["frame"], []).append(entry)
                for number, entries in by_frame.items():
                    raw = frame_bytes(data, frames[number])
                    yield _rows(
                        [parsed_record(raw[e["offset"] : e["offset"] + e["length"]]) for e in entries],
                        with_payload,
                    )

    schema = RECORDS + (", payload binary" if with_payload else "")
    return bundles.select("data", "index").mapInArrow(read, schema)


def fetch(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records named by ``wanted.record_id``, with payloads; only their frames are decompressed."""
    places = (
        bundles.select("bundle", F.explode("index").alias("at"))
        .select("bundle", "at.*")
        .join(wanted.select("record_id").distinct(), "record_id")
        .groupBy("bundle")
        .agg(F.collect_list(F.struct("frame", "offset", "length")).alias("places"))
    )

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                frames = seek_table(data)
                for e in entries:
                    raw = frame_bytes(data, frames[e["frame"]])
                    yield _rows([parsed_record(raw[e["offset"] : e["offset"] + e["length"]])], True)

    found = bundles.select("bundle", "data").join(places, "bundle").select("data", "places")
    return found.mapInArrow(seek, RECORDS + ", payload binary")


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes every bundle as ``<bundle>.warc.zst`` to a folder that all executors mount."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = os.path.join(folder, f"{name}.warc.zst")
                part = f"{path}.{TaskContext.get().taskAttemptId()}"
                with open(part, "wb") as out:
                    out.write(data)
                os.replace(part, path)
                yield pa.RecordBatch.from_pydict({"path": [path]})

    return bundles.select("bundle", "data").mapInArrow(put, "path string")
