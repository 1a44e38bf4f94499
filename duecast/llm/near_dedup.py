"""Near-duplicates by SetSketch registers.

A document is the set of its word shingles. Register i of its sketch is

    floor(1 - log_b(x_i / scale)),  x_i the least of exponential variates,
                                    one per shingle,

cut off at 0 and 65535: minima on an exponential scale, merged by max, equal in
two sketches with a probability that grows with the sets' similarity. ``BANDS``
bands of ``ROWS`` registers gather candidates: each row is compared with one
leader of its bucket, never with all. The joint likelihood of the larger, smaller
and equal registers of a pair estimates its similarity; pairs far below the
threshold are dropped. The remaining links only gather rows into neighbourhoods.
Inside a neighbourhood all sets are compared exactly, so a pair is found although
neither is near the leader, and what is linked has been verified on full sets.

Equal word sequences are one row from the start, whatever their number. A
neighbourhood above ``PART_ROWS`` rows or ``PART_SHINGLES`` shingles is dealt
over parts: all parts meet the first one, and only rows that this leaves outside
the largest component meet all parts. No task emits pairs, only each row's least
linked row.

Band misses: at the threshold of 0.8 a pair shares no band with probability
(1 - 0.8**4)**28 < 4e-7. A band whose leader is a third text unlike both links them
neither: in a crowd with boilerplate of some 60 percent of the union, where 0.6**4 of
0.8**4 such bands lead elsewhere, about (1 - 0.28)**28 = 1e-4 of the pairs are missed.

Cases: words are what lies between ``[\\x20\\x09-\\x0D]``, A-Z in lower case; a
text of fewer words than a shingle is one shingle of all of them; a text without
words, a null text and a row without identifier are linked with nothing; rows that
repeat an identifier are rows of their own; an empty table stays empty; other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ..sources.storage import stored
from .common import body, holding, tidy
from .components import components
from .membership import membership

WORDS = 4
SIMILAR = 80
"""Percent of the union that the intersection of two linked sets reaches."""
BANDS, ROWS = 28, 4
BASE = 1.001
SCALE = 20.0
LEADERS = 4
"""Orders by which the leader of a bucket is chosen, band by band."""
DISTANT = 0.5
"""Candidates estimated below this are dropped: eight standard errors under 0.8."""
PART_ROWS = 1024
PART_SHINGLES = 1 << 20
GROUP_SHINGLES = 1 << 18
COLUMNS = 2048
REMEMBERED = 100_000

_RANDOM = np.random.default_rng(5)
FACTORS = (_RANDOM.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
MASKS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
MIX = (_RANDOM.integers(0, 1 << 63, 16, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORD_HASH = _WordHashes()


def words_of(text: bytes) -> list[bytes]:
    """bytes.split and bytes.lower know ASCII only, as the definition of words does."""
    return text.lower().split()


def shingles(words: list[bytes], size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(WORD_HASH.__getitem__, words), np.uint64, len(words))
    holding("near_dedup", WORD_HASH.clear)
    count = min(size, len(words))
    mixed = np.full(len(words) - count + 1, count, np.uint64)
    for i in range(count):
        mixed = (mixed + hashes[i : len(words) - count + 1 + i] * MIX[i % 16]) * MIX[(i + 7) % 16]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes. Sketches of two sets merge by the larger register."""
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 4096):
        part = (low[start : start + 4096][None, :] ^ MASKS[:, None]) * FACTORS[:, None]
        part ^= part >> np.uint32(15)
        np.minimum(least, (part * np.uint32(0x9E3779B1)).min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    level = np.floor(1 - np.log(exponential / SCALE) / np.log(BASE))
    return np.clip(level, 0, 65535).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """Four registers of 16 bits are one key of 64 bits, without loss."""
    return sketch.reshape(BANDS, ROWS).view(np.int64).ravel()


def estimated(sizes: np.ndarray, others: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of pairs by joint likelihood of the registers that are larger, smaller and equal."""
    more, less = (left > right).sum(axis=1), (left < right).sum(axis=1)
    equal = left.shape[1] - more - less
    grid = np.linspace(0.0, 1.0, 101)[None, :]
    u = (sizes / np.maximum(sizes + others, 1))[:, None]
    v = 1 - u
    # Similarity cannot exceed the ratio of the sizes.
    possible = grid <= np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12)) + 1e-9
    above = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    p_more, p_less = above(u - v * grid), above(v - u * grid)
    p_equal = np.clip(1 - p_more - p_less, 1e-12, 1)
    likelihood = (
        more[:, None] * np.log(np.maximum(p_more, 1e-12))
        + less[:, None] * np.log(np.maximum(p_less, 1e-12))
        + equal[:, None] * np.log(p_equal)
    )
    return grid[0][np.where(possible, likelihood, -np.inf).argmax(axis=1)]


def sketched(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(doc_id, same, n_shingles, sketch): ``same`` is a digest of the word sequence, null without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            same, counts, sketches = [], [], []
            for doc, data in zip(ids, batch.column(1).to_pylist()):
                words = words_of(data)
                hashes = shingles(words, size)
                counts.append(len(hashes))
                linked = len(hashes) and doc is not None
                same.append(xxhash.xxh3_128_digest(b" ".join(words)) if linked else None)
                sketches.append(registers(hashes).tobytes() if linked else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(same, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "same", "n_shingles", "sketch"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body(text).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(sketch), "doc_id long, same binary, n_shingles long, sketch binary")


def word_digest(text: Column) -> Column:
    """The digest ``same`` of a text."""

    @arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        words = (words_of(data) for data in texts.to_pylist())
        return pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if len(w) else None for w in words], pa.binary())

    return digest(body(text).cast("binary"))


def candidates(sets: DataFrame) -> DataFrame:
    """(u, v): rows of (node, n_shingles, sketch) and leaders that are not far from them."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bands(np.frombuffer(s, np.uint16)) for s in batch.column(1).to_pylist()]
            if found:
                values = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.asarray(batch.column(0)), BANDS)),
                        pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(found))),
                        pa.array(values),
                    ],
                    names=["node", "band", "value"],
                )

    banded = sets.select("node", "sketch").mapInArrow(tidy(keys), "node long, band int, value long")
    order = F.struct(F.xxhash64("node", F.col("band") % LEADERS), "node")
    buckets = banded.groupBy("band", "value").agg(F.min(order)["node"].alias("leader"), F.count("*").alias("rows"))
    # Stored, as are the other small sides of joins on keys that a crowd may share: only
    # joins of two plain shuffles are split by adaptive execution.
    shared = stored(buckets.where("rows > 1").drop("rows"), "shared_buckets")
    pairs = (
        banded.join(shared, ["band", "value"])
        .where("node <> leader")
        .select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v"))
        .distinct()
    )
    side = lambda name: sets.select(
        F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}")
    )
    paired = pairs.join(side("u"), "u").join(side("v"), "v")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                side_of = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(
                    len(batch), -1
                )
                sizes = [np.asarray(batch.column(c)).astype(float) for c in ("n_u", "n_v")]
                kept = estimated(*sizes, side_of("s_u"), side_of("s_v")) >= DISTANT
                yield batch.select(["u", "v"]).filter(pa.array(kept))

    return paired.select("u", "v", "n_u", "n_v", "s_u", "s_v").mapInArrow(tidy(near), "u long, v long")


def least_linked(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """The component of every set (of ``others`` after ``sets``) by exact comparison: its least position.

    Compares ``sets`` with each other, or with ``others`` if given. Shingles of
    one set only can add nothing to an intersection and are left out.
    """
    both = sets + (others or [])
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    _, column, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    numbers = np.cumsum(times > 1) - 1
    column, owner = numbers[column[shared]], owner[shared]
    by_column = np.argsort(column, kind="stable")
    column, owner = column[by_column], owner[by_column]
    first, rest = (len(sets), len(others)) if others is not None else (len(sets), len(sets))
    common = np.zeros((first, rest), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((len(both), COLUMNS), np.float32)
        held[owner[low:high], column[low:high] - start] = 1
        common += held[:first] @ (held[first:] if others is not None else held).T
    size = np.array([len(s) for s in both], dtype=np.float64)
    union = size[:first, None] + size[first:][None, :] if others is not None else size[:, None] + size[None, :]
    linked = 100 * common >= SIMILAR * (union - common)
    label = np.arange(len(both))
    place = np.arange(len(both))
    a, b = (place[:first], place[first:]) if others is not None else (place, place)
    while True:
        before = label.copy()
        top, side = label[a], label[b]
        lower = np.where(linked, side[None, :], len(both)).min(axis=1, initial=len(both))
        label[a] = np.minimum(top, lower)
        lower = np.where(linked, label[a][:, None], len(both)).min(axis=0, initial=len(both))
        label[b] = np.minimum(label[b], lower)
        label = label[label]
        if (label == before).all():
            return label


def as_sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint64) for s in column.to_pylist()]


def compared(table: pa.Table) -> pa.Table:
    """(u, v): the links of all neighbourhoods (``hood``) of a group, each row's least linked one."""
    table = table.sort_by([("hood", "ascending"), ("node", "ascending")])
    hoods, nodes, sets = np.asarray(table["hood"]), np.asarray(table["node"]), as_sets(table["shingles"])
    u, v = [], []
    starts = np.flatnonzero(np.concatenate([[True], hoods[1:] != hoods[:-1]])) if len(hoods) else []
    for start, stop in zip(starts, [*starts[1:], len(hoods)]):
        label = least_linked(sets[start:stop]) + start
        moved = np.flatnonzero(label != np.arange(start, stop)) + start
        u.append(nodes[moved])
        v.append(nodes[label[moved - start]])
    return _links(u, v)


def _links(u: list[np.ndarray], v: list[np.ndarray]) -> pa.Table:
    join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
    return pa.table({"u": join(u), "v": join(v)})


def met(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between the rows of two parts of a neighbourhood, or within one part."""
    a, b = np.asarray(left["node"]), np.asarray(right["node"])
    if not len(a) or not len(b):
        return _links([], [])
    label = least_linked(as_sets(left["shingles"]), as_sets(right["shingles"]))
    nodes = np.concatenate([a, b])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return _links([nodes[moved]], [nodes[label[moved]]])


def _met_by(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Links of every part of (hood, part, node, shingles) with every part of ``hubs`` of its neighbourhood."""
    # Columns of their own, as both sides may come from one table.
    hubs = hubs.select(*[F.col(c).alias(c) for c in ("hood", "part", "node", "shingles")])
    pairs = hubs.select("hood", F.col("part").alias("with")).distinct()
    spread = rows.join(pairs, "hood").select("hood", "part", "with", "node", "shingles")
    own = rows.select(F.col("hood").alias("hood"), F.col("part").alias("to")).distinct()
    aimed = hubs.join(own, "hood").select(
        "hood", F.col("to").alias("part"), F.col("part").alias("with"), "node", "shingles"
    )
    cell = ["hood", "part", "with"]
    return spread.groupBy(*cell).cogroup(aimed.groupBy(*cell)).applyInArrow(met, "u long, v long")


def hot_links(rows: DataFrame) -> DataFrame:
    """Links of neighbourhoods that are dealt over parts (hood, parts, node, shingles)."""
    # The order of a hash makes the first part a fair sample of the neighbourhood.
    part = F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts"))
    rows = stored(rows.withColumn("part", part), "hot_rows")
    links = stored(_met_by(rows, rows.where("part = 0")), "hot_links")
    found = components(links)
    sizes = rows.select("hood", "node").join(found, "node").groupBy("hood", "component").count()
    core = sizes.groupBy("hood").agg(F.max(F.struct("count", "component"))["component"].alias("core"))
    core = stored(core, "hot_cores")
    cores = stored(found.join(core, F.col("component") == F.col("core"), "left_semi").select("node"), "hot_core")
    outside = stored(rows.join(cores, "node", "left_anti"), "hot_outside")
    count = outside.groupBy("hood").agg(F.count("*").alias("n"), F.sum(F.length("shingles") / 8).alias("s"))
    count = stored(count, "hot_sizes")
    again = outside.join(count, "hood").withColumn("part", F.pmod(F.xxhash64("node", F.lit(13)), _parts("n", "s")))
    rest = stored(again.select("hood", "part", "node", "shingles"), "hot_rest")
    return links.unionByName(_met_by(rows, rest))


def _parts(rows: str, total: str):
    return F.greatest(F.ceil(F.col(rows) / PART_ROWS), F.ceil(F.col(total) / PART_SHINGLES))


def with_shingles(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The rows of ``wanted`` (node, same, least, ..) with their shingles, from one text of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(data) for data in batch.column("text").to_pylist()]
            # An identifier that repeats may have other texts.
            right = [xxhash.xxh3_128_digest(b" ".join(w)) == s for w, s in zip(words, batch.column("same").to_pylist())]
            sets = [shingles(w, size).tobytes() if r else b"" for w, r in zip(words, right)]
            columns = {n: batch.column(n) for n in ("hood", "parts", "node")} | {"shingles": pa.array(sets, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(right, pa.bool_()))

    # Texts of rows without candidates stay out of the shuffle.
    rows = docs.where(membership(wanted.select("least"))(F.col(key)))
    rows = rows.select(F.col(key).cast("long").alias("least"), body(text).cast("binary").alias("text"))
    joined = rows.join(wanted, "least").select("hood", "parts", "node", "same", "text")
    return joined.mapInArrow(tidy(cut), "hood long, parts long, node long, shingles binary").dropDuplicates(["node"])


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    return linked(docs, key, text, size).select("doc_id", "n_shingles", "component_id", "kept")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """What ``link`` returns, the digest ``same`` of the words, and ``chosen``: kept, and of the least words.

    Rows that repeat an identifier may all be kept; in each component those with one digest are chosen.
    """
    rows = stored(sketched(docs, key, text, size), "sketches")
    classes = rows.where("same is not null").groupBy("same").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    sets = stored(classes.withColumn("node", F.xxhash64("same")), "classes")
    near = candidates(sets)
    hoods = stored(components(near), "neighbourhoods")
    members = stored(hoods.join(sets.select("node", "same", "least", "n_shingles"), "node"), "hood_members")
    weight = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    weight = stored(weight, "hood_sizes")
    wanted = members.join(weight, "component").select(
        F.col("component").alias("hood"), _parts("n", "s").alias("parts"), "node", "same", "least"
    )
    held = stored(with_shingles(docs, stored(wanted, "members"), key, text, size), "member_sets")
    cold = held.where("parts = 1")
    total = cold.agg(F.coalesce(F.sum(F.length("shingles") / 8), F.lit(0))).first()[0]
    groups = max(1, int(total // GROUP_SHINGLES))
    links = cold.groupBy(F.pmod(F.xxhash64("hood"), F.lit(groups)).alias("_group")).applyInArrow(
        compared, "u long, v long"
    )
    hot = held.where("parts > 1")
    if not hot.isEmpty():
        links = links.unionByName(hot_links(hot))
    found = components(links)
    named = sets.select("same", "node", "least").join(found, "node", "left")
    named = stored(named.select("same", "least", F.coalesce("component", "node").alias("root")), "class_roots")
    first = stored(named.groupBy("root").agg(F.min(F.struct("least", "same")).alias("first")), "class_first")
    shown = ["same", F.col("first.least").alias("_component"), (F.col("same") == F.col("first.same")).alias("_first")]
    named = stored(named.join(first, "root").select(*shown), "class_components")
    joined = rows.drop("sketch").join(named, "same", "left")
    component = F.coalesce(F.col("_component"), F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        "same",
        F.coalesce((component == F.col("doc_id")) & F.col("_first"), F.lit(True)).alias("chosen"),
    )
