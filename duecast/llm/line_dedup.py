"""Removal of lines that many documents share, found by two Bloom filters.

The first pass marks every long line in a filter of hashes seen once and, where
the bits of a document's line were set before, in a filter of hashes seen twice.
Filters of tasks merge: once = once | once, twice = twice | twice | once & once.
The second pass probes the filter of hashes seen twice, which may hold too much
but never too little, and only the lines it suspects are shuffled, as texts, to
count their documents exactly and choose the one that keeps them.

The filters have 16 bits for each line, up to ``MAX_BITS``. Beyond that the
filter suspects more lines; the exact count stays right and is then the cost of
a plain shuffle of lines. A line that a third of all documents share is counted
with partial sums before the shuffle, and its join is split by adaptive
execution.

A line's key is the line without white space at both ends and with A-Z in lower
case. A key of at least ``min_chars`` characters in at least ``min_docs``
documents loses all its lines but those of the largest identifier.

Cases: a null or empty text is one empty line; rows without identifier keep all
their lines and do not count; rows that share an identifier are one document;
other columns pass through; an empty table stays empty; input columns named
``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ..sources.storage import stored
from .common import SPACE, body, kept, lean, packed, tidy, unpacked
from .membership import membership

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
BLOCK_BITS = 1 << 20
MAX_BITS = 1 << 29
ADDED = ["n_lines", "n_dropped"]


def long_keys(text: bytes, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that are long enough."""
    keys = {line.strip().lower() for line in text.split(b"\n") if len(line) >= min_chars}
    # A character has at most four bytes.
    return {
        k for k in keys if len(k) >= 4 * min_chars or len(k) >= min_chars and len(k.decode()) >= min_chars
    }


def probes(keys: list[bytes], bits: int) -> np.ndarray:
    """The two bits of each key."""
    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes + step * np.uint64(0x9E3779B1)) & mask], axis=1)


def _blocks(positions: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Filter blocks of a task from the bits its documents set, in order of bits."""
    places, seen = np.unique(positions, return_counts=True)
    block = places // BLOCK_BITS
    for number in np.unique(block):
        inside = block == number
        once, twice = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
        at = places[inside] - number * BLOCK_BITS
        once[at], twice[at] = True, seen[inside] > 1
        yield int(number), _packed(np.packbits(once)), _packed(np.packbits(twice))


def _packed(bits: np.ndarray) -> bytes:
    return zlib.compress(bits.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.uint8)


def twice_seen(texts: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The merged filter of hashes seen twice, at most ``MAX_BITS`` bits, as bytes."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_bits = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                keys = list(long_keys(text, min_chars))
                if keys:
                    set_bits.append(np.unique(probes(keys, bits)))
        if set_bits:
            lot = TaskContext.get().partitionId()
            blocks = list(_blocks(np.concatenate(set_bits).astype(np.int64)))
            number, once, twice = map(list, zip(*blocks))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(number, pa.int32()),
                    "lot": pa.array([lot] * len(number), pa.int32()),
                    "once": pa.array(once, pa.binary()),
                    "twice": pa.array(twice, pa.binary()),
                }
            )

    def merge(group: pa.Table) -> pa.Table:
        once = twice = np.zeros(BLOCK_BITS // 8, np.uint8)
        for one, two in zip(group["once"].to_pylist(), group["twice"].to_pylist()):
            more = _unpacked(one)
            twice = twice | _unpacked(two) | (once & more)
            once = once | more
        return pa.table(
            {
                "block": group["block"].slice(0, 1),
                "lot": group["lot"].slice(0, 1),
                "once": pa.array([_packed(once)], pa.binary()),
                "twice": pa.array([_packed(twice)], pa.binary()),
            }
        )

    schema = "block int, lot int, once binary, twice binary"
    tasks = texts.rdd.getNumPartitions()
    # Two steps, so that no task merges more than the root of all tasks' blocks.
    filled = texts.mapInArrow(tidy(fill), schema).withColumn("lot", F.col("lot") % math.isqrt(tasks) + 1)
    lots = filled.groupBy("block", "lot").applyInArrow(merge, schema)
    merged = lots.groupBy("block").applyInArrow(merge, schema).select("block", "twice")
    result = np.zeros(bits // 8, np.uint8)
    for block, twice in merged.collect():
        part = _unpacked(bytes(twice))[: bits // 8]
        result[block * BLOCK_BITS // 8 :][: len(part)] = part
    return result


def suspects(texts: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """(doc_id, line): the distinct long keys of each row whose bits are in the filter."""
    spark = texts.sparkSession
    seen = spark.sparkContext.broadcast(twice_seen(texts.select("text"), bits, min_chars))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = seen.value
        for batch in batches:
            ids, lines = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = list(long_keys(text, min_chars))
                if keys:
                    at = probes(keys, bits).astype(np.int64)
                    # numpy packs the first of eight bits highest.
                    hit = ((filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                    found = [keys[i] for i in np.flatnonzero(hit)]
                    ids += [doc] * len(found)
                    lines += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([k.decode() for k in lines], pa.string())],
                names=["doc_id", "line"],
            )

    return texts.select("doc_id", "text").mapInArrow(tidy(probe), "doc_id long, line string")


def without(text: Column, lines: Column) -> Column:
    """(text, lost): a text without the lines whose keys are listed, and how many it had."""

    @arrow_udf("struct<text: string, lost: long>")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        lean()
        out = []
        for body_, found in zip(texts.to_pylist(), lists.to_pylist()):
            gone = {x.encode() for x in found or ()}
            # bytes.strip and bytes.lower know ASCII only, as the definition of a key does.
            parts = (body_ or "").encode().split(b"\n")
            left = [x for x in parts if x.strip(SPACE.encode()).lower() not in gone]
            out.append({"text": b"\n".join(left).decode(), "lost": len(parts) - len(left)})
        return pa.array(out, pa.struct([("text", pa.string()), ("lost", pa.int64())]))

    return cut(text, lines)


def drop_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with the kept text, ``n_lines`` (before) and ``n_dropped``."""
    columns = kept(docs, ADDED)
    count = lambda column: F.regexp_count(column, F.lit("\n")).cast("long") + 1
    lines = docs.agg(F.coalesce(F.sum(count(body(text))), F.lit(0))).first()[0]
    bits = min(MAX_BITS, max(BLOCK_BITS, 1 << (BITS_PER_LINE * lines - 1).bit_length()))
    texts = docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), body(text).cast("binary").alias("text")
    )
    suspected = stored(suspects(texts, bits, min_chars), "suspected_lines")
    shared = (
        suspected.groupBy("line")
        .agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("line", "keeper")
    )
    dropped = (
        suspected.join(stored(shared, "shared_lines"), "line")
        .where("doc_id < keeper")
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_set("line").alias("_lines"))
    )
    dropped = stored(dropped, "dropped_lines")
    own, before = F.col("row").getField(key).cast("long"), F.col("row").getField(text)
    rows = packed(docs, columns)
    # Only documents that may lose a line are shuffled.
    maybe = membership(dropped.select("_doc"))(own)
    joined = rows.where(maybe).join(dropped, own == F.col("_doc"), "left")
    joined = joined.withColumn("_kept", F.when(F.col("_lines").isNotNull(), without(before, F.col("_lines"))))

    def shown(rows: DataFrame, after: Column, lost: Column) -> DataFrame:
        return rows.select(
            *[after.alias(c) if c == text else column for c, column in zip(columns, unpacked(columns))],
            count(body(before)).alias("n_lines"),
            lost.cast("long").alias("n_dropped"),
        )

    after = F.when(F.col("_lines").isNotNull(), F.col("_kept.text")).otherwise(before)
    changed = shown(joined, after, F.coalesce("_kept.lost", F.lit(0)))
    return shown(rows.where(~maybe), before, F.lit(0)).unionByName(changed)
