"""Exact k nearest by inner product: a dual-tree search over cover trees.

Queries and data are indexed together. The upper level is a set of pivots, a
farthest-first net of a bounded sample; every row belongs to its nearest pivot,
and the rows of a pivot are dealt over blocks of bounded size. A pair of pivots
is pruned when no row of the one can reach the worst k-th score of the queries
of the other:

    q . d <= cq . cd + |cq| rd + |cd| rq + rq rd

with centres c and covering radii r. The first k-th scores come from the sample.
Inside a block both sides get a cover tree, and pairs of nodes are visited
best bound first, pruned by the same rule with k-th scores that grow. A pair of
leaves is one matrix product, of which only scores that reach a query's k-th
are looked at. Equal bounds are never pruned, so ties are right.

A cell, a block of data met by a chunk of queries, is as large as a task can hold: every row of the data is
sent once a chunk and every query once a block. Vectors travel as bytes of the least width that holds them.

Equal vectors are one entry with its smallest k + 1 identifiers, which is all
that a list of k other rows can hold of it; equal queries are one query.

Cases: a vector that is null or holds a null or non-finite component takes no
part, nor does a row without identifier; vectors of different lengths are not
compared; a row that repeats identifier and vector counts once; rows with a
query's identifier are the query's own; fewer than k others give fewer rows;
empty tables give no rows; other columns are ignored. Products are taken in
doubles where they are exact and in integers of any size elsewhere; a score
beyond a long is shown as the largest one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.storage import stored

SAMPLE_ROWS = 8192
"""Vectors that reach the driver to choose pivots and first k-th scores from; all rows are indexed."""

PIVOTS = 64
BLOCK_ROWS = 1 << 18
CHUNK_ROWS = 1 << 16
LEAF_ROWS = 2048
FANOUT = 32
ROWS_AT_ONCE = 1024
PAIRS_A_TASK = 1 << 22
SCALE = 1024
LONG = (1 << 63) - 1


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as a long, the nearest one where there is none."""
    with np.errstate(over="ignore"):
        y = np.floor(SCALE * x)
    inside = np.abs(y) < 2.0**63
    return np.where(inside, np.where(inside, y, 0).astype(np.int64), np.where(y > 0, LONG, -LONG - 1))


def as_bytes(vectors: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows and their bytes: the width of an integer, then the integers. Equal vectors have equal bytes."""
    most = np.maximum(vectors, ~vectors).max(axis=1, initial=0)
    widths = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    for width in np.unique(widths):
        index = np.flatnonzero(widths == width)
        raw = np.empty((len(index), 1 + vectors.shape[1] * width), np.uint8)
        raw[:, 0] = width
        raw[:, 1:] = np.ascontiguousarray(vectors[index].astype(f"<i{width}")).view(np.uint8).reshape(len(index), vectors.shape[1] * width)
        offsets = np.arange(len(index) + 1, dtype=np.int32) * raw.shape[1]
        yield index, pa.BinaryArray.from_buffers(pa.binary(), len(index), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, vec, asks) of the usable vectors, ``vec`` quantised and as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            x = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            stops = np.cumsum(sizes)
            bad = np.append(0, np.cumsum(~np.isfinite(x)))
            good = np.asarray(lists.is_valid()) & (bad[stops] == bad[stops - sizes])
            for dims in np.unique(sizes[good]):
                own = np.flatnonzero(good & (sizes == dims))
                values = x[(stops - sizes)[own][:, None] + np.arange(dims)]
                for index, vec in as_bytes(quantised(values)):
                    held = [batch.column(c).take(pa.array(own[index])) for c in ("vec_id", "asks")]
                    yield pa.RecordBatch.from_arrays([held[0], vec, held[1]], names=["vec_id", "vec", "asks"])

    return rows.mapInArrow(pack, "vec_id long, vec binary, asks boolean")


def parts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a column, where each value begins, and where the last one ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8), offsets[:-1], offsets[1:]


def lengths(column: pa.Array) -> np.ndarray:
    """How many integers each value of ``as_bytes`` holds."""
    if not len(column):
        return np.zeros(0, np.int64)
    raw, starts, stops = parts_of(column)
    return (stops - starts - 1) // raw[starts]


def numbers(column: pa.Array) -> np.ndarray:
    """(row, component) of vectors of one length, in the least width that holds them all."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    raw, starts, stops = parts_of(column)
    widths, dims = raw[starts], int(lengths(column[:1])[0])
    found = [int(w) for w in np.unique(widths)]
    if not dims or len(found) == 1:
        held = raw[starts[0] : stops[-1]].reshape(len(column), -1)[:, 1:]
        return np.ascontiguousarray(held).view(f"<i{found[0]}").reshape(len(column), dims)
    out = np.empty((len(column), dims), f"<i{found[-1]}")
    for width in found:
        out[widths == width] = numbers(column.filter(pa.array(widths == width)))
    return out


def longest(rows: np.ndarray) -> float:
    """The largest squared length of a row."""
    parts = (rows[i : i + 8192].astype(np.float64) for i in range(0, len(rows), 8192))
    return max((float((p * p).sum(axis=1).max(initial=0)) for p in parts), default=0.0)


def arithmetic(*sides: np.ndarray) -> type:
    """The quickest type in which sums and differences of products of these integers are exact.

    No part of an inner product is above the product of both lengths.
    """
    most = 4 * max(longest(side) for side in sides)
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


@dataclass
class Node:
    start: int
    stop: int
    centre: np.ndarray
    radius: float
    children: list[Node]
    norm: float = field(init=False)

    def __post_init__(self) -> None:
        self.norm = float(np.linalg.norm(self.centre))


class CoverTree:
    """Nested balls. ``order`` lists the rows so that every node holds a slice of it.

    The children of a node are a farthest-first net at half its radius, at most
    ``FANOUT`` of them and no more than leaves need; radii are the true covering radii.
    """

    def __init__(self, rows: np.ndarray) -> None:
        kind = arithmetic(rows)
        self.exact = kind is not object
        self.rows = rows.astype(kind if self.exact else np.float64)
        self.order = np.arange(len(rows))
        self.root = self.build(0, len(rows), self.rows[0] if len(rows) else np.zeros(0))

    def apart(self, rows: np.ndarray, squares: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Squared distances; by products only where these are exact, as differences of large ones are not."""
        return squares + centre @ centre - 2 * (rows @ centre) if self.exact else ((rows - centre) ** 2).sum(axis=1)

    def build(self, start: int, stop: int, centre: np.ndarray) -> Node:
        index = self.order[start:stop].copy()
        rows = self.rows[index]
        squares = np.einsum("ij,ij->i", rows, rows)
        near = self.apart(rows, squares, centre)
        node = Node(start, stop, centre.astype(np.float64), float(np.sqrt(np.float64(near.max(initial=0)))), [])
        if stop - start <= LEAF_ROWS or node.radius == 0:
            return node
        most = min(FANOUT, max(8, -(-2 * (stop - start) // LEAF_ROWS)))
        centres, owner = [int(near.argmin())], np.zeros(len(index), dtype=np.int8)
        near = self.apart(rows, squares, rows[centres[0]])
        while len(centres) < most and near.max() > (node.radius**2 / 4 if len(centres) > 1 else 0):
            far = int(near.argmax())
            distance = self.apart(rows, squares, rows[far])
            closer = distance < near
            owner[closer], near = len(centres), np.minimum(near, distance)
            centres.append(far)
        if len(centres) == 1:
            return node
        middles = [rows[c] for c in centres]
        del rows, squares, near
        at = start
        for number, middle in enumerate(middles):
            members = index[owner == number]
            if len(members):
                self.order[at : at + len(members)] = members
                node.children.append(self.build(at, at + len(members), middle))
                at += len(members)
        return node


def reach(a: Node, b: Node) -> float:
    """No product of a row of ``a`` and a row of ``b`` is above this."""
    most = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
    return most + 1.0 + 1e-9 * abs(most)


def best_in_block(
    queries: np.ndarray, floors: np.ndarray, data: np.ndarray, firsts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, place): the scores and the data rows (-1: none) of the ``k`` best rows here at or above a query's floor.

    Ties go to the smaller of ``firsts``, the rows' smallest identifiers.
    """
    kind = arithmetic(queries, data)
    left, right = CoverTree(queries), CoverTree(data)
    left.rows = right.rows = None
    values_q, values_d = queries[left.order].astype(kind), data[right.order].astype(kind)
    firsts, kth, last = firsts[right.order], floors[left.order].astype(np.float64), np.full(len(queries), LONG)
    wide = object if kind is object else np.float64
    scores = np.full((len(queries), k), -(1 << 200) if wide is object else -np.inf, dtype=wide)
    found, ties = np.full((len(queries), k), -1, dtype=np.int64), np.full((len(queries), k), LONG)
    heap, count = [(-reach(left.root, right.root), 0, left.root, right.root)], 0
    while heap:
        bound, _, q, d = heapq.heappop(heap)
        if -bound < kth[q.start : q.stop].min():
            continue
        if q.children or d.children:
            split_q = q.children and (not d.children or q.radius >= d.radius)
            for pair in [(c, d) for c in q.children] if split_q else [(q, c) for c in d.children]:
                count += 1
                heapq.heappush(heap, (-reach(*pair), count, *pair))
            continue
        new = values_q[q.start : q.stop] @ values_d[d.start : d.stop].T
        low = kth[q.start : q.stop]
        if kind is np.float32:
            low = np.nextafter(np.ceil(low).astype(np.float32), np.float32(-np.inf))
        hit = np.flatnonzero(new.max(axis=1) >= low)
        new, low = new[hit], low[hit, None]
        above = new >= low
        if kind is not object and k < new.shape[1] and np.count_nonzero(above) > 8 * k * len(hit):
            above = new >= np.maximum(low, np.partition(new, -k, axis=1)[:, -k, None])
        row, column = np.nonzero(above)
        score = new[row, column].astype(wide)
        row, column = hit[row] + q.start, column + d.start
        kept = (score > kth[row]) | ((score == kth[row]) & (firsts[column] <= last[row]))
        row, column, score = row[kept], column[kept], score[kept]
        if not len(row):
            continue
        touched, row = np.unique(row, return_inverse=True)
        of = np.concatenate([np.repeat(np.arange(len(touched)), k), row])
        all_scores = np.concatenate([scores[touched].ravel(), score])
        all_ties = np.concatenate([ties[touched].ravel(), firsts[column]])
        all_found = np.concatenate([found[touched].ravel(), column])
        if wide is object:
            order = np.array(sorted(range(len(of)), key=lambda i: (of[i], -all_scores[i], all_ties[i], all_found[i] < 0)))
        else:
            order = np.lexsort((all_ties, -all_scores, of))
        # Every query brings its k places, so that there are k to take.
        best = order[(np.searchsorted(of[order], np.arange(len(touched))))[:, None] + np.arange(k)]
        scores[touched], found[touched], ties[touched] = all_scores[best], all_found[best], all_ties[best]
        worst = scores[touched, -1].astype(np.float64)
        # In doubles a score of any size may be shown too large.
        kth[touched] = np.maximum(kth[touched], worst - 1e-9 * np.abs(worst) if wide is object else worst)
        last[touched] = LONG if wide is object else ties[touched, -1]
    back, known = np.argsort(left.order), found >= 0
    found[known] = right.order[found[known]]
    return scores[back], found[back]


def farthest_first(rows: np.ndarray, count: int) -> np.ndarray:
    chosen = [0]
    near = np.linalg.norm(rows - rows[0], axis=1)
    while len(chosen) < min(count, len(rows)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(rows - rows[chosen[-1]], axis=1))
    return rows[chosen]


def indexed(entries: DataFrame, pivots: np.ndarray, sample: np.ndarray, k: int = 0) -> DataFrame:
    """Adds to ``entries`` (vec, ..) its length, the nearest pivot, the distance to it and, for a ``k``, the k-th best score in the sample.

    Vectors of another length than the pivots belong to pivot -1, the origin.
    """
    added = [("dims", pa.int32()), ("pivot", pa.int32()), ("away", pa.float64())] + [("least", pa.float64())] * bool(k)
    kinds = {"dims": "int", "pivot": "int", "away": "double", "least": "double"}
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in entries.schema] + [f"{c} {kinds[c]}" for c, _ in added]
    squares = (pivots**2).sum(axis=1) if len(pivots) else 0

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = lengths(batch.column("vec"))
            out = {"dims": dims, "pivot": np.full(len(dims), -1), "away": np.zeros(len(dims)), "least": np.full(len(dims), -np.inf)}
            for size in np.unique(dims):
                own = np.flatnonzero(dims == size)
                for at in np.split(own, range(ROWS_AT_ONCE, len(own), ROWS_AT_ONCE)):
                    rows = numbers(batch.column("vec").take(pa.array(at))).astype(np.float64)
                    centre = np.zeros(size)
                    if len(pivots) and size == pivots.shape[1]:
                        out["pivot"][at] = nearest = (squares - 2 * rows @ pivots.T).argmin(axis=1)
                        centre = pivots[nearest]
                        if k and len(sample) >= k:
                            low = np.partition(rows @ sample.T, -k, axis=1)[:, -k]
                            out["least"][at] = np.where(np.isfinite(low), low - 1.0 - 1e-9 * np.abs(low), -np.inf)
                    out["away"][at] = np.sqrt(((rows - centre) ** 2).sum(axis=1))
            arrays = [*batch.columns, *[pa.array(out[c], t) for c, t in added]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *[c for c, _ in added]])

    return entries.mapInArrow(place, ", ".join(schema))


def hits_of(scores: np.ndarray, found: np.ndarray, ids: pa.Array, k: int) -> tuple[pa.Array, pa.Array]:
    """Per query the ``k`` best (lost, vec_id) of its entries, as two lists; lost is the score with its sign changed."""
    row, place = np.nonzero(found >= 0)
    sizes = np.asarray(ids.value_lengths())
    starts, entry = np.cumsum(sizes) - sizes, found[row, place]
    lost = scores[row, place]
    lost = np.array([-max(-LONG, min(LONG, int(s))) for s in lost], np.int64) if scores.dtype == object else -lost.astype(np.int64)
    each = np.repeat(np.arange(len(entry)), sizes[entry])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(sizes[entry]) - sizes[entry], sizes[entry])
    named = np.asarray(ids.flatten())[starts[entry][each] + nth]
    order = np.lexsort((named, lost[each], row[each]))
    begins = np.searchsorted(row[each][order], np.arange(len(found)))
    counts = np.diff(np.append(begins, len(order)))
    order = order[np.arange(len(order)) - np.repeat(begins, counts) < k]
    offsets = pa.array(np.append(0, np.cumsum(np.minimum(counts, k))), pa.int32())
    return tuple(pa.ListArray.from_arrays(offsets, pa.array(v[order], pa.int64())) for v in (lost[each], named))


def open_pairs(data: list, queries: list, pivots: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(dims, query pivot, data pivot, blocks) of the pivot pairs that no radius rules out."""
    open_ = []
    centre = lambda dims, p: pivots[p] if p >= 0 else np.zeros(dims)
    for q in queries:
        for d in data:
            if q["dims"] == d["dims"]:
                one = Node(0, 0, centre(q["dims"], q["pivot"]), q["radius"], [])
                two = Node(0, 0, centre(d["dims"], d["pivot"]), d["radius"], [])
                if reach(one, two) >= q["least"]:
                    open_.append((q["dims"], q["pivot"], d["pivot"], -(-d["rows"] // BLOCK_ROWS)))
    return open_


def search(
    rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query with other rows."""
    spark = rows.sparkSession
    known = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"), is_query.alias("asks")
    )
    # Spark reduces a group to its first k + 1 rows before the shuffle.
    first = Window.partitionBy("vec").orderBy("vec_id")
    entries = (
        packed(known).select("vec", "vec_id").distinct()
        .withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= k + 1)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = stored(entries, "entries")
    drawn = entries.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE_ROWS).toArrow()["vec"].combine_chunks()
    sizes = lengths(drawn)
    dims = int(np.bincount(sizes).argmax()) if len(sizes) else 0
    sample = numbers(drawn.filter(pa.array(sizes == dims))).astype(np.float64)
    pivots = farthest_first(sample, PIVOTS) if len(sample) else sample

    data = stored(indexed(entries, pivots, sample), "indexed")
    asking = packed(known.where("asks")).select("vec", F.col("vec_id").alias("query_id")).distinct()
    asking = stored(asking.withColumn("query", F.xxhash64("vec")), "asking")
    queries = asking.groupBy("vec").agg(F.min("query_id").alias("first"), F.first("query").alias("query"))
    queries = stored(indexed(queries, pivots, sample, k + 1), "queries")

    # At most PIVOTS + 1 groups for each length of vector.
    summary = lambda df, *more: df.groupBy("dims", "pivot").agg(
        F.max("away").alias("radius"), F.count("*").alias("rows"), *more
    ).collect()
    pairs = open_pairs(summary(data), asked := summary(queries, F.min("least").alias("least")), pivots)
    schema = "dims int, pivot int, target int, blocks long"
    pairs_df = spark.createDataFrame(pairs or [(0, 0, 0, 0)], schema)
    aimed = queries.join(F.broadcast(pairs_df), ["dims", "pivot"])
    rounds: dict[tuple[int, int], int] = {}
    per_pivot = {(q["dims"], q["pivot"]): q["rows"] for q in asked}
    for dims_, pivot, target, _ in pairs:
        rounds[dims_, target] = rounds.get((dims_, target), 0) + per_pivot[dims_, pivot]
    chunks = [(d, t, -(-n // CHUNK_ROWS)) for (d, t), n in rounds.items()] or [(0, 0, 0)]
    chunks_df = spark.createDataFrame(chunks, "dims int, target int, chunks long")
    blocks_df = pairs_df.select("dims", "target", "blocks").distinct().join(chunks_df, ["dims", "target"])
    # Many places for few cells, as cells are long tasks and their bytes say little about their time.
    blocks = {(d, t): b for d, _, t, b in pairs}
    cells = sum(blocks[d, t] * c for d, t, c in chunks if (d, t) in blocks)
    work = sum(blocks[at] * BLOCK_ROWS * n for at, n in rounds.items())
    places = max(1, min(1000, 2 * cells, work // PAIRS_A_TASK))

    block = ["dims", "target", "block", "chunk"]
    spread = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    asked_blocks = (
        aimed.join(F.broadcast(chunks_df), ["dims", "target"])
        .withColumn("chunk", F.pmod(F.xxhash64("vec", F.lit(1)), F.col("chunks")))
        .withColumn("block", spread("blocks"))
        .select(*block, "vec", "first", "query", "least")
    )
    data_blocks = (
        data.withColumnRenamed("pivot", "target")
        .join(F.broadcast(blocks_df), ["dims", "target"])
        .withColumn("block", F.pmod(F.xxhash64("vec", F.lit(2)), F.col("blocks")))
        .withColumn("chunk", spread("chunks"))
        .select(*block, "vec", "ids")
    )

    def meet(asked_: pa.Table, held: pa.Table) -> pa.Table:
        asked_ = asked_.select(["first", "query", "least", "vec"]).combine_chunks()
        lists = [pa.array([], pa.list_(pa.int64()))] * 2
        if len(asked_) and len(held):
            ids = held["ids"].combine_chunks()
            firsts = np.asarray(ids.flatten())[np.cumsum(sizes := np.asarray(ids.value_lengths())) - sizes]
            sides = [numbers(side["vec"].combine_chunks()) for side in (asked_, held)]
            scores, found = best_in_block(sides[0], np.asarray(asked_["least"]), sides[1], firsts, k + 1)
            lists = hits_of(scores, found, ids, k + 1)
        kept = asked_.select(["first", "query"]).slice(0, len(lists[0]))
        return kept.append_column("lost", lists[0]).append_column("found", lists[1])

    hits = (
        asked_blocks.repartition(places, *block).groupBy(*block)
        .cogroup(data_blocks.repartition(places, *block).groupBy(*block))
        .applyInArrow(meet, "first long, query long, lost array<long>, found array<long>")
    )
    pair = F.arrays_zip("lost", F.col("found").alias("vec_id"))
    lists = hits.where(F.size("lost") > 0).groupBy("first", "query").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list(pair))), 1, k + 1).alias("hits")
    )
    lists = lists.join(queries.select("first", "query", "vec"), ["first", "query"])
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return (
        asking.select("vec", "query_id")
        .join(stored(lists.select("vec", "hits"), "lists"), "vec")
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.lost")).alias("score"))
    )
