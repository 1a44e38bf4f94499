"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors are scaled to length one, so that a cosine of at least ``least`` means a squared
distance of at most t = 2 - 2 ``least``. A fixed random rotation spreads them evenly over their
dimensions, which are split into blocks. A pair within t in all dimensions is within
(d / D) t in at least one block of d of D dimensions, so each block is range-joined under this budget and
the union of what the blocks find is verified on whole vectors.

A range join deals the rows over the cells of pivots in the block, chosen from a bounded
sample. A row is at home with its nearest pivot and visits each cell of higher number that a
row within the budget of it may be at home in, as its distance to the plane between the two
pivots tells. Cells are cut into parts of ``PART_ROWS`` homes, and the visitors of a part into slices, so
that a crowd in one cell is shared by many tasks; homes are held, visitors stream past
them. No task emits pairs: it counts each row's links and emits an edge for a visitor and
for each home that a visitor ties to another, which keeps what is connected connected.

A pair is counted in the first block whose budget it keeps. This is decided on coordinates
rounded to multiples of 2**-20, whose squared distances are exact in doubles, so all tasks
decide alike; the budget is wider by more than the rounding. Links are decided on the cosine in doubles.

Equal vectors are one row from the start, whatever their number; each of them is linked with all others.
A crowd of n different vectors that are all near each other takes n * n / 2 comparisons in each block, dealt over tasks.

Cases: a vector that is null, empty or zero or holds a null or non-finite component is
linked with nothing, nor is a row without identifier; vectors of different lengths are not
linked; rows that repeat an identifier are rows of their own; an empty table stays empty;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.storage import stored
from .common import partitions
from .components import components

LEAST = 0.95
BLOCKS = 4
SAMPLE_ROWS = 4096
"""Vectors that reach the driver to choose pivots from; all rows are joined."""
PIVOTS, MOST_PIVOTS = 16, 512
"""Cells of a block: one for each ``PART_ROWS`` rows within these bounds."""
PART_ROWS = 16_384
"""Most homes that a task holds, on average of a dealing by hash."""
MOST_TASKS = 20_000
CHUNK = 512
"""Visitors that are compared at once with ``CHUNK`` * 8 homes."""
GRAIN = float(1 << 20)
SLACK = 1e-4

Batches = Iterator[pa.RecordBatch]


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of length one in doubles, shorter ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten()).astype(np.float64)
    rows = np.zeros((len(lists), width))
    rows[np.arange(width)[None, :] < sizes[:, None]] = flat
    rows /= np.abs(rows).max(axis=1, keepdims=True, initial=0)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Space:
    """The rotation, its blocks, their budgets and pivots."""

    def __init__(self, width: int, least: float, sample: np.ndarray, pivots: int, chunk: int) -> None:
        self.width, self.least, self.chunk = width, least, chunk
        self.rotation = np.linalg.qr(np.random.default_rng(13).normal(size=(width, width)))[0]
        edges = np.linspace(0, width, min(BLOCKS, width) + 1).round().astype(int)
        self.blocks = [slice(a, b) for a, b in zip(edges, edges[1:])]
        share = np.diff(edges) / width
        self.radius = np.sqrt(share * max(0.0, 2 - 2 * least)) + SLACK
        turned = sample @ self.rotation
        self.pivots = [self._pivots(turned[:, b], 2 * r, pivots) for b, r in zip(self.blocks, self.radius)]

    @staticmethod
    def _pivots(rows: np.ndarray, apart: float, count: int) -> np.ndarray:
        """The first rows that lie apart from those chosen before."""
        chosen = rows[:1]
        for row in rows[1:]:
            if len(chosen) < count and ((chosen - row) ** 2).sum(axis=1).min() > apart**2:
                chosen = np.vstack([chosen, row])
        return chosen

    def grains(self, rows: np.ndarray) -> np.ndarray:
        """Rotated coordinates as whole numbers."""
        return np.rint(rows @ self.rotation * GRAIN)

    def cells(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, home cell of each row, whether it visits each cell)."""
        turned = rows @ self.rotation
        for at, (block, radius, pivots) in enumerate(zip(self.blocks, self.radius, self.pivots)):
            far = ((turned[:, block][:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2)
            home = far.argmin(axis=1)
            between = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))
            beyond = far - far[np.arange(len(far)), home][:, None]
            reaches = beyond <= 2 * radius * between[home]
            yield at, home, reaches & (np.arange(len(pivots))[None, :] > home[:, None])


def census(classes: DataFrame, space: Space) -> dict[tuple[int, int], tuple[int, int]]:
    """(homes, visitors) of each block and cell: a row each, as few as there are pivots."""

    def count(batches: Batches) -> Batches:
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for block, home, visits in space.cells(matrix(batch.column("vector"), space.width)):
                for cell in range(visits.shape[1]):
                    held = sums.setdefault((block, cell), [0, 0])
                    held[0] += int((home == cell).sum())
                    held[1] += int(visits[:, cell].sum())
        rows = [(*k, *v) for k, v in sums.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("block", "cell", "homes", "visitors"), r)) for r in rows], pa.schema([(n, pa.int64()) for n in ("block", "cell", "homes", "visitors")]))

    counts = classes.select("vector").mapInArrow(count, "block long, cell long, homes long, visitors long")
    sums = counts.groupBy("block", "cell").agg(F.sum("homes"), F.sum("visitors")).collect()
    return {(block, cell): (homes, visitors) for block, cell, homes, visitors in sums}


def dealt(classes: DataFrame, space: Space, sizes: dict[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """(block, cell, part, slice, kind, node, n, vector): kind 0 at home, 1 visiting."""
    parts = {at: max(1, -(-homes // PART_ROWS)) for at, (homes, _) in sizes.items()}
    # Rows of later parts visit the earlier ones of their own cell.
    slices_ = {at: max(1, -(-(v + (h if parts[at] > 1 else 0)) // (4 * PART_ROWS))) for at, (h, v) in sizes.items()}
    names = ("block", "cell", "part", "slice", "kind")

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            node = np.asarray(batch.column("node"))
            mixed = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            for block, home, visits in space.cells(matrix(batch.column("vector"), space.width)):
                for cell in range(visits.shape[1]):
                    key = (block, cell)
                    own_part = (mixed % np.uint64(parts[key])).astype(np.int64)
                    own_slice = ((mixed >> np.uint64(16)) % np.uint64(slices_[key])).astype(np.int64)
                    for part in range(parts[key]):
                        inside = home == cell
                        at_home = inside & (own_part == part)
                        guests = visits[:, cell] | (inside & (own_part > part))
                        for turn in range(slices_[key]):
                            rows = np.concatenate([np.flatnonzero(at_home), np.flatnonzero(guests & (own_slice == turn))])
                            if len(rows):
                                kind = np.r_[np.zeros(at_home.sum(), int), np.ones(len(rows) - at_home.sum(), int)]
                                taken = batch.take(pa.array(rows))
                                fixed = [pa.array(np.full(len(rows), x)) for x in (block, cell, part, turn)]
                                yield pa.RecordBatch.from_arrays(
                                    [*fixed, pa.array(kind), *taken.columns], [*names, "node", "n", "vector"]
                                )

    kind = classes.schema["vector"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in (*names, "node", "n"))
    return classes.select("node", "n", "vector").mapInArrow(deal, f"{longs}, vector {kind}")


class Homes:
    """The homes of a part, with the visitors that pass by."""

    def __init__(self, space: Space, block: int) -> None:
        self.space, self.block = space, block
        self.gathered: list[tuple] = []
        self.nodes = self.links = self.label = np.zeros(0, np.int64)

    def settle(self) -> None:
        self.nodes, self.counts, self.rows, self.sizes = (np.concatenate(x) for x in zip(*self.gathered))
        self.grains = self.space.grains(self.rows)
        self.gathered = []
        self.links = np.zeros(len(self.nodes), np.int64)
        self.label = np.arange(len(self.nodes))

    def linked(self, rows: np.ndarray, grains: np.ndarray, sizes: np.ndarray, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Positions (row, home) of the links that this block counts, with homes of ``at``."""
        ours, own_size = self.grains[at], self.sizes[at]

        def kept_budget(block: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            part = self.space.blocks[block]
            a, b = left[:, part], right[:, part]
            # Whole numbers: exact, whatever the order of the sum.
            far = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
            return far <= (self.space.radius[block] * GRAIN) ** 2

        near = kept_budget(self.block, grains, ours)
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(i):
            return i, j
        good = near[np.ix_(i, j)] & (sizes[i][:, None] == own_size[j][None, :])
        good &= rows[i] @ self.rows[at][j].T >= self.space.least
        for earlier in range(self.block):
            good &= ~kept_budget(earlier, grains[i], ours[j])
        a, b = np.nonzero(good)
        return i[a], j[b] + at.start

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        """Homes at a and at b are connected."""
        while len(a):
            low = np.minimum(self.label[a], self.label[b])
            before = self.label.copy()
            for side in (a, b):
                np.minimum.at(self.label, self.label[side], low)
                np.minimum.at(self.label, side, low)
            self.label = self.label[self.label]
            if (self.label == before).all():
                return

    def meet(self, nodes: np.ndarray, counts: np.ndarray, rows: np.ndarray, sizes: np.ndarray, own: bool = False) -> list[tuple]:
        """(u, v, links) of visitors, or of the homes themselves against those before them."""
        found, chunk = [], self.space.chunk
        for start in range(0, len(nodes), chunk):
            some = slice(start, start + chunk)
            grains = self.space.grains(rows[some])
            links, least = np.zeros(len(grains), np.int64), np.full(len(grains), -1)
            stop = start + len(grains) if own else len(self.nodes)
            for first in range(0, stop, 8 * chunk):
                at = slice(first, min(stop, first + 8 * chunk))
                i, j = self.linked(rows[some], grains, sizes[some], at)
                if own:
                    before = j < i + start
                    i, j = i[before], j[before]
                if not len(i):
                    continue
                np.add.at(links, i, self.counts[j])
                np.add.at(self.links, j, counts[some][i])
                new = i[least[i] < 0]
                least[new[::-1]] = j[least[i] < 0][::-1]
                self.tie(least[i], j)
            hit = np.flatnonzero(links)
            found.append((nodes[some][hit], self.nodes[least[hit]], links[hit]))
        return found

    def done(self) -> list[tuple]:
        hit = np.flatnonzero(self.links)
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return [
            (self.nodes[hit], self.nodes[hit], self.links[hit]),
            (self.nodes[moved], self.nodes[self.label[moved]], np.zeros(len(moved), np.int64)),
        ]


def met(rows: DataFrame, space: Space, groups: int) -> DataFrame:
    """(u, v, links): what every part's homes and visitors find; u = v only adds links."""
    names = ["block", "cell", "part", "slice"]

    def shown(found: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate([f[c] for f in found] + [np.zeros(0, np.int64)]) for c in range(3)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v", "links"])

    def settled(homes: Homes, first: bool) -> Batches:
        """All homes have come. Those of the first slice meet each other."""
        if homes.gathered:
            homes.settle()
            if first:
                yield shown(homes.meet(homes.nodes, homes.counts, homes.rows, homes.sizes, own=True))

    def meet(batches: Batches) -> Batches:
        key, homes = None, Homes(space, 0)
        for batch in batches:
            columns = [np.asarray(batch.column(n)) for n in (*names, "kind")]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(batch)]) if len(batch) else ():
                now = tuple(int(c[start]) for c in columns[:4])
                if now != key:
                    if key:
                        yield from settled(homes, key[3] == 0)
                        yield shown(homes.done())
                    key, homes = now, Homes(space, now[0])
                part = batch.slice(start, stop - start)
                vectors = part.column("vector")
                sizes = np.diff(np.asarray(vectors.offsets))
                taken = (np.asarray(part.column("node")), np.asarray(part.column("n")), matrix(vectors, space.width), sizes)
                if columns[4][start] == 0:
                    homes.gathered.append(taken)
                else:
                    yield from settled(homes, key[3] == 0)
                    yield shown(homes.meet(*taken))
        if key:
            yield from settled(homes, key[3] == 0)
            yield shown(homes.done())

    ordered = rows.repartition(groups, *names).sortWithinPartitions(*names, "kind")
    return ordered.mapInArrow(meet, "u long, v long, links long")


def link(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    good = F.col(key).isNotNull() & usable(F.col(vector))
    same = [F.xxhash64(F.col(vector)).alias("h1"), F.xxhash64(F.lit(1), F.col(vector)).alias("h2")]
    hashed = rows.select(F.col(key).cast("long").alias("id"), *[F.when(good, h).alias(n) for h, n in zip(same, ("h1", "h2"))])
    hashed = stored(hashed, "vector_digests")
    classes = rows.where(good).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), *same)
    classes = classes.groupBy("h1", "h2").agg(
        F.min("id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    # The numbers are fixed once they are written.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector_classes")
    total, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    spark = rows.sparkSession
    if total:
        sample = classes.orderBy("h1", "h2").limit(SAMPLE_ROWS).select("vector").toArrow()
        pivots = min(MOST_PIVOTS, max(PIVOTS, total // PART_ROWS))
        space = Space(width, least, matrix(sample["vector"], width), pivots, CHUNK)
        sizes = census(classes, space)
        tasks = sum(-(-h // PART_ROWS) * max(1, -(-(h + v) // (4 * PART_ROWS))) for h, v in sizes.values())
        found = met(dealt(classes, space, sizes), space, max(partitions(spark), min(tasks, MOST_TASKS)))
    else:
        found = spark.createDataFrame([], "u long, v long, links long")
    found = stored(found, "vector_links")
    links = stored(found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links")), "link_counts")
    groups = stored(components(found.where("u <> v").select("u", "v")), "vector_components")
    named = classes.select("h1", "h2", "node", "least", "n").join(groups, "node", "left").join(links, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "class_links")
    first = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "component_least")
    named = named.join(first, "component").select(
        "h1", "h2", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    joined = hashed.join(stored(named, "class_results"), ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
