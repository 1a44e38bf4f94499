"""Document fingerprints from content-defined chunks.

A gear hash, the sum of the last 32 bytes' table values shifted by their age,
marks chunk boundaries where its top bits are 0. Chunking is normalised: up to
``NORMAL`` bytes a boundary needs seven such bits, beyond only five, so lengths stay
between ``LEAST`` and ``MOST`` and close to ``NORMAL``. Boundaries depend on the
text near them alone, so an insertion changes only the chunks around it.

The fingerprint is the set of chunk digests with lengths, as text: ``DIGITS``
hexadecimal digits of a digest and two of the length less one, for each distinct chunk in
order of digest. Its likeness to another is the share of its bytes, over
distinct chunks, that the other has too: containment weighted by length.

Neighbours in the order of identifiers are compared without sorting it as a
whole: sampled identifiers cut ranges, each range is sorted in a task, and the
first document of every range is also sent to the range before it.

Cases: a null text is the empty text; the empty text has the empty fingerprint,
like only the empty one; a text shorter than ``LEAST`` bytes is one chunk; null
identifiers come last; rows that share an identifier follow in order of a hash
of their texts; the only document is its own neighbour; an empty table stays
empty; columns of other names take no part.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import body, partitions, uniform

LEAST, NORMAL, MOST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 5
WINDOW = 32
DIGITS = 12
ENTRY = DIGITS + 2
RANGE_ROWS = 20_000
MOST_RANGES = 10_000
"""The driver holds samples and a line of each range."""
SAMPLES_PER_RANGE = 16

GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, by doubling the window."""
    hashes = GEAR[data]
    width = 1
    while width < WINDOW:
        older = hashes[:-width] << np.uint32(width)
        hashes = hashes.copy()
        hashes[width:] += older
        width *= 2
    return hashes


def boundaries(data: bytes) -> list[int]:
    """The ends of the chunks of ``data``."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    hashes = gear_hashes(np.frombuffer(data, np.uint8))
    loose = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = loose[hashes[loose] >> np.uint32(32 - STRICT_BITS) == 0].tolist()
    loose = loose.tolist()
    ends, start = [], 0
    while size - start > LEAST:
        normal, most = start + NORMAL, min(start + MOST, size)
        # A boundary after byte i ends the chunk at i + 1.
        at = bisect_left(strict, start + LEAST - 1)
        end = strict[at] + 1 if at < len(strict) and strict[at] < normal else 0
        if not end:
            at = bisect_left(loose, normal)
            end = loose[at] + 1 if at < len(loose) and loose[at] < most else most
        ends.append(min(end, size))
        start = ends[-1]
    if start < size:
        ends.append(size)
    return ends


def chunks(data: bytes) -> dict[str, int]:
    """Digest and length of the distinct chunks."""
    found, start = {}, 0
    for end in boundaries(data):
        found[xxhash.xxh3_64_hexdigest(data[start:end])[:DIGITS]] = end - start
        start = end
    return found


def written(found: dict[str, int]) -> str:
    return "".join([f"{digest}{found[digest] - 1:02x}" for digest in sorted(found)])


def read(fingerprint: str) -> dict[str, int]:
    entries = [fingerprint[i : i + ENTRY] for i in range(0, len(fingerprint), ENTRY)]
    return {e[:DIGITS]: int(e[DIGITS:], 16) + 1 for e in entries}


def contained(one: dict[str, int], other: dict[str, int]) -> float:
    """The share of ``one``'s bytes that ``other`` has, 1 for two empty ones."""
    total = sum(one.values())
    if not total:
        return float(not other)
    return sum([size for digest, size in one.items() if digest in other]) / total


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @arrow_udf("string")
    def make(texts: pa.Array) -> pa.Array:
        return pa.array([written(chunks((t or "").encode())) for t in texts.to_pylist()], pa.string())

    return make(text)


def containment(one: Column, other: Column) -> Column:
    """How much of the first fingerprint the second holds, 0 to 1."""

    @arrow_udf("double")
    def share(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([None if a is None or b is None else contained(read(a), read(b)) for a, b in pairs], pa.float64())

    return share(one, other)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, extra): sorted by descending identifier within ranges; the last rows of a range
    (``extra``) are the first of the next one."""
    spark = docs.sparkSession
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("_id"))
    count = ids.count()
    ranges = min(max(8 * partitions(spark), count // RANGE_ROWS), MOST_RANGES)
    rate = min(1.0, ranges * SAMPLES_PER_RANGE / max(count, 1))
    # At most about SAMPLES_PER_RANGE identifiers for each range.
    sample = ids.where(uniform(F.col("_id"), F.lit(6)) < F.lit(rate)).distinct().toArrow()["_id"]
    sample = np.sort(np.asarray(sample))
    cuts = sample[np.unique(np.linspace(0, len(sample), ranges, endpoint=False).astype(int))[1:]]

    @arrow_udf("int")
    def number(id_: pa.Array) -> pa.Array:
        return pa.array((len(cuts) - np.searchsorted(cuts, np.asarray(id_), "right")).astype(np.int32))

    # One line per range.
    heads = sorted(ids.groupBy(number("_id").alias("r")).agg(F.max("_id")).collect())
    firsts = [(first, heads[at - 1][0]) for at, (_, first) in enumerate(heads)]
    firsts = spark.createDataFrame(firsts, "_id long, _to int")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body(text).alias("text"), order.alias("_id"))
    rows = rows.withColumn("_range", number("_id")).join(F.broadcast(firsts), "_id", "left")
    here = F.struct(F.col("_range").alias("range"), F.lit(False).alias("extra"))
    there = F.struct(F.col("_to").alias("range"), F.lit(True).alias("extra"))
    sent = F.when(F.col("_to").isNull(), F.array(here)).otherwise(F.array(here, there))
    rows = rows.withColumn("_sent", F.explode(sent)).select("doc_id", "text", "_id", "_sent.range", "_sent.extra")
    return rows.repartition(partitions(spark), "range").sortWithinPartitions(
        "range", "extra", F.desc("_id"), F.xxhash64("text"), "text"
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
RESULT_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]


def with_neighbour(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and how much of the first the second
    and the following document hold."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            for doc, body_, range_, extra in zip(*[c.to_pylist() for c in batch.columns]):
                own = chunks(body_.encode())
                if held and held[3] == range_:
                    out.append(_compared(held[0], held[1], held[2], body_, own))
                held = None if extra else (doc, body_, own, range_)
            columns = list(zip(*out)) if out else [[]] * len(RESULT_TYPES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, RESULT_TYPES)],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    rows = in_order(docs, key, text).select("doc_id", "text", "range", "extra")
    return rows.mapInArrow(follow, RESULT)


def _compared(doc: int | None, text: str, own: dict, following: str, following_chunks: dict) -> tuple:
    changed = edited(text, following).encode()
    changed_chunks = chunks(changed)
    return (
        doc,
        len(text),
        hashlib.sha256(changed).hexdigest(),
        written(own),
        written(changed_chunks),
        contained(own, changed_chunks),
        contained(own, following_chunks),
    )
