"""Shards of near equal size by sampled splitters.

Records are ordered by (hash of the text, identifier). A sample in proportion to
size gives splitters at equal steps of weight, many more than shards. The exact
bytes of every range are then counted, ranges that came out overfull are
sampled and divided again, and the running totals of the ranges give every
record its place in the whole: its shard by bytes, its slot by rows. One task
orders one range, never a shard.

Equal texts are neighbours. A group of them stays in one shard unless it holds
more than ``TOLERANCE`` of a shard's bytes; then it is divided by identifier, so
that no group can make shards unequal. A group with two or more splitters in it
is also divided over ranges.

Sizes are the UTF-8 bytes of the text plus 8. Law ``bytes``: the sizes of two
shards differ by about ``2 * TOLERANCE`` of a shard or by one record.

Cases: a null text counts no bytes and has the checksum of the empty text; null
identifiers come before all others; rows equal in identifier and text are
neighbours in any order; fewer rows than shards leave shards empty; an empty
table stays empty; input columns named like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from ..sources.storage import by_folder, stored
from .common import body, kept, uniform, unpacked

RECORD_BYTES = 8
RANGES_PER_SHARD = 64
RANGE_ROWS = 5_000_000
MOST_RANGES = 10_000
"""Ranges hold keys of some sixty bytes a record; the driver holds samples and a line of each."""
SAMPLES_PER_RANGE = 8
TOLERANCE = 0.02
OVERFULL = 3.0
SEED = 3
FIRST = -(1 << 63)
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]

Splitter = tuple[int, int]


def splitters(sample: list[tuple[int, int, float]], ranges: int) -> list[Splitter]:
    """Boundaries at equal steps of weight. A single one inside a group of equal texts moves to its start."""
    sample = sorted(sample)
    weights = np.cumsum([w for *_, w in sample])
    if not len(weights):
        return []
    steps = np.searchsorted(weights, weights[-1] * np.arange(1, ranges) / ranges)
    cuts = sorted({sample[i][:2] for i in steps})
    alone = {h: 0 for h, _ in cuts}
    for h, _ in cuts:
        alone[h] += 1
    return [(h, i if alone[h] > 1 else FIRST) for h, i in cuts]


def range_of(cuts: list[Splitter]):
    """The number of the range that holds (hash, identifier)."""
    hashes = np.array([h for h, _ in cuts], dtype=np.int64)
    ids = np.array([i for _, i in cuts], dtype=np.int64)

    @arrow_udf("int")
    def number(hash_: pa.Array, id_: pa.Array) -> pa.Array:
        h, i = np.asarray(hash_), np.asarray(id_)
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        place = low.copy()
        for row in np.flatnonzero(low < high):
            place[row] += np.searchsorted(ids[low[row] : high[row]], i[row], "right")
        return pa.array(place.astype(np.int32))

    return number("_hash", "_id")


def drawn(rows: DataFrame, rate: float) -> list[tuple[int, int, float]]:
    """A sample in proportion to size; a record of more than one share weighs its shares."""
    picked = rows.where(uniform(F.col("_hash"), F.col("_id"), F.lit(SEED)) < F.col("size") * F.lit(rate))
    weight = F.greatest(F.lit(1.0), F.col("size") * F.lit(rate))
    return [tuple(r) for r in picked.groupBy("_hash", "_id").agg(F.sum(weight)).collect()]


def balanced(keys: DataFrame, total: int, ranges: int) -> tuple[list[Splitter], DataFrame]:
    """Splitters and the keys with their ranges, after dividing overfull ranges.

    The driver holds the sample and one line per range; their number follows
    from the number of ranges alone.
    """
    share = total / ranges
    cuts = splitters(drawn(keys, SAMPLES_PER_RANGE / share), ranges)
    while True:
        placed = keys.withColumn("_range", range_of(cuts))
        filled = placed.groupBy("_range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > OVERFULL * share)
        overfull = [r["_range"] for r in filled.collect()]
        again = drawn(placed.where(F.col("_range").isin(overfull)), 4 * SAMPLES_PER_RANGE / share) if overfull else []
        more = splitters(again, max(1, len(again) // SAMPLES_PER_RANGE))
        grown = sorted(set(cuts) | set(more))
        if grown == cuts:
            return cuts, placed
        cuts = grown


def assign(
    docs: DataFrame, shards: int = 24, keep: list[str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The columns ``keep`` (all, by default) of ``docs`` with size, checksum, shard and slot.

    ``keep`` without the text keeps texts out of the shuffle.
    """
    columns = [c for c in kept(docs, ADDED) if keep is None or c in keep]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        (F.octet_length(body(text)).cast("long") + RECORD_BYTES).alias("size"),
        F.crc32(body(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(body(text)).alias("_hash"),
        F.coalesce(F.col(key).cast("long"), F.lit(FIRST)).alias("_id"),
    )
    rows = stored(rows, "sized")
    keys = rows.select("_hash", "_id", "size")
    total, count = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = min(max(shards * RANGES_PER_SHARD, count // RANGE_ROWS), max(shards, MOST_RANGES))
    cuts, placed = balanced(keys, max(total, 1), ranges)

    # One line per range: at most a small multiple of ``ranges``.
    filled = sorted(placed.groupBy("_range").agg(F.sum("size"), F.count("*")).collect())
    starts, at_bytes, at_rows = [], 0, 0
    for number, size, count in filled:
        starts.append((number, at_bytes, at_rows))
        at_bytes, at_rows = at_bytes + size, at_rows + count
    schema = "_range int, _bytes_before long, _rows_before long"
    offsets = rows.sparkSession.createDataFrame(starts, schema)

    in_order = Window.partitionBy("_range").orderBy("_hash", "_id")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("_range", "_hash")
    ranged = rows.withColumn("_range", range_of(cuts)).join(F.broadcast(offsets), "_range")
    ranged = ranged.withColumns(
        {
            "_before": F.col("_bytes_before") + F.coalesce(F.sum("size").over(so_far), F.lit(0)),
            "_row": F.col("_rows_before") + F.row_number().over(in_order) - 1,
        }
    ).withColumns({"_group": F.sum("size").over(group), "_start": F.min("_before").over(group)})
    small = F.col("_group") <= F.lit(TOLERANCE * total / shards)
    middle = F.when(small, F.col("_start") + F.col("_group") / 2).otherwise(F.col("_before") + F.col("size") / 2)
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(max(total, 1))))).cast("int")
    assigned = stored(ranged.select("row", "size", "text_crc32", shard.alias("shard"), "_row"), "assigned")
    first = assigned.groupBy("shard").agg(F.min("_row").alias("_first"))
    return assigned.join(F.broadcast(first), "shard").select(
        *unpacked(columns),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write(docs: DataFrame, path: str, shards: int = 24, **options) -> None:
    """Writes every shard into a folder of its own."""
    by_folder(assign(docs, shards, **options), ["shard"]).write.partitionBy("shard").parquet(path)
