"""The prefix trie of conversations, with subtree sums rolled up by depth bands.

A node is a sequence of turns that conversations begin with; the root has none.
Its key is the sum of the hashes of its turns with their places, 128 bits, so keys
of all prefixes are running sums and a conversation of any length is dealt
over slices like any large group.

Subtree sums go up in bands of ``BAND`` levels. The nodes of a band are grouped by
(conversation that names them, band); each group holds at most ``BAND`` of them and
adds what they have to the ancestors within the band only. The totals of band roots
are then completed among themselves, by the same step on the trie of
band roots whose depths are ``BAND`` times smaller, and the completed totals are added to the
ancestors in the band above. So there are log_BAND(depth) rounds, and a node is
exploded to at most ``BAND`` ancestors in each.

Cases: turns are ordered by ``turn``, null first, and turns of equal ``turn`` by the
digest of role and text; equal rows count as often as they occur; a null role or text is
empty; rows without conversation identifier take no part; a conversation without turns
is a member of the root; no conversations give no nodes; other columns are ignored. The
identifiers that end at a node are hashed as a stream of pieces, never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.positions import positions, running_sums
from ..sources.storage import stored
from .common import body, partitions

BAND = 16
"""Levels of a band."""

HOT_ROWS = 1_000_000
"""Turns of a conversation above which it is dealt over slices."""

PIECE = 1 << 14
"""Identifiers that are hashed as one piece."""

LOW = (1 << 32) - 1
KEY = ["depth", "hi", "lo"]


def numbered(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, at, digest, chars): turns by place from 1, without their texts."""
    role, text = body("role"), body("text")
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    turns = stored(turns, "turn_digests")
    placed = positions(turns, ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest")], "at", HOT_ROWS)
    return placed.select("conv", (F.col("at") + 1).alias("at"), "digest", "chars")


def borrowed(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their family's first conversation.

    ``turns`` as ``numbered`` gives them. Of conversation c the first h = crc32(c) mod ``most`` turns are
    replaced by those of c - c % ``family``. Returns the turns (conv, at, digest, chars, length)
    and the conversations (conv, length), also those left without turns.
    """
    turns = stored(turns, "numbered_turns")
    own = turns.groupBy("conv").agg(F.count("*").alias("n"))
    own = stored(own.withColumn("base", F.col("conv") - F.col("conv") % family), "conversation_lengths")
    heads = own.select(F.col("conv").alias("base"), F.col("n").alias("of_base"))
    cut = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    plan = own.join(heads, "base", "left").withColumn("cut", cut)
    plan = plan.withColumn("taken", F.least("cut", F.coalesce("of_base", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("cut"), F.lit(0))
    plan = stored(plan.select("conv", "base", "cut", "taken", length.alias("length")), "conversation_plan")
    first = turns.where((F.col("conv") % family == 0) & (F.col("at") < most)).withColumnRenamed("conv", "base")
    before = plan.join(first, "base").where("at <= taken")
    after = turns.join(plan, "conv").where("at > cut").withColumn("at", F.col("at") - F.col("cut") + F.col("taken"))
    columns = ["conv", "at", "digest", "chars", "length"]
    return before.select(*columns).unionByName(after.select(*columns)), plan.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, hi, lo, phi, plo, chars, length): the key of every prefix and of the one before it."""
    one, two = F.xxhash64("at", "digest"), F.xxhash64("digest", "at")
    halves = {
        "a": F.shiftrightunsigned(one, 32), "b": one.bitwiseAND(F.lit(LOW)),
        "c": F.shiftrightunsigned(two, 32), "d": two.bitwiseAND(F.lit(LOW)),
    }
    turns = stored(turns.select("conv", "at", "chars", "length", *[v.alias(f"own_{k}") for k, v in halves.items()]), "turn_hashes")
    summed = running_sums(turns, ["conv"], [F.col("at")], {k: F.col(f"own_{k}") for k in halves}, HOT_ROWS)

    def packed(high: Column, low: Column) -> Column:
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))

    earlier = {k: F.col(k) - F.col(f"own_{k}") for k in halves}
    return summed.select(
        "conv",
        F.col("at").cast("long").alias("depth"),
        packed(F.col("a"), F.col("b")).alias("hi"),
        packed(F.col("c"), F.col("d")).alias("lo"),
        packed(earlier["a"], earlier["b"]).alias("phi"),
        packed(earlier["c"], earlier["d"]).alias("plo"),
        "chars",
        "length",
    )


def _carried(paths: DataFrame, values: DataFrame, step: int) -> DataFrame:
    """(depth, hi, lo, leaves, saved): what values (conv, band, from, leaves, saved) add to their paths.

    A path is what its conversation has in one band; a value counts for entries down to the depth ``from``.
    """
    entries = paths.where(F.col("depth") % step == 0).select(
        "conv",
        F.floor(F.col("depth") / (step * BAND)).alias("band"),
        F.struct(*KEY).alias("entry"),
        F.lit(None).cast("struct<from:long,leaves:long,saved:long>").alias("value"),
    )
    added = values.select("conv", "band", F.lit(None).cast(entries.schema["entry"].dataType).alias("entry"), F.struct("from", "leaves", "saved").alias("value"))
    # At most BAND entries and as many values have one conversation and band.
    groups = entries.unionByName(added).groupBy("conv", "band").agg(
        F.collect_list("entry").alias("entries"), F.collect_list("value").alias("values")
    )

    def total(name: str, entry: Column) -> Column:
        below = F.filter("values", lambda v: v["from"] >= entry["depth"])
        return F.aggregate(below, F.lit(0).cast("long"), lambda so_far, v: so_far + v[name])

    deepest = F.array_max(F.transform("values", lambda v: v["from"]))
    sums = F.transform(
        F.filter("entries", lambda e: e["depth"] <= deepest),
        lambda e: F.struct(*[e[k].alias(k) for k in KEY], total("leaves", e).alias("leaves"), total("saved", e).alias("saved")),
    )
    spread = groups.where(F.size("values") > 0).select(F.explode(sums).alias("sum")).select("sum.*")
    return spread.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rolled_up(paths: DataFrame, nodes: DataFrame, deepest: int, step: int = 1) -> DataFrame:
    """(depth, hi, lo, leaves, saved): sums over the subtrees of nodes at depths divisible by ``step``.

    ``paths`` (conv, depth, hi, lo) has every prefix of the conversations, ``nodes`` the conversation that
    names a node and its own ``leaves`` and ``saved``.
    """
    height = step * BAND
    band = F.floor(F.col("depth") / height)
    own = nodes.select("conv", band.alias("band"), F.col("depth").alias("from"), "leaves", "saved")
    within = _carried(paths, own, step)
    if deepest < height:
        return within
    within = stored(within, "band_totals")
    names = nodes.where(F.col("depth") % height == 0).select("conv", *KEY)
    roots = stored(names.join(within, KEY), "band_roots")
    whole = rolled_up(paths, roots, deepest, height)
    done = whole.where("depth > 0").join(names, KEY)
    # A completed root counts for the whole path of the band above it.
    above = done.select("conv", (band - 1).alias("band"), F.col("depth").alias("from"), "leaves", "saved")
    both = within.unionByName(_carried(paths, above, step))
    return stored(both.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "whole_totals")


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (depth, hi, lo, conv) as one row of joined identifiers each."""
    node, ids, first = None, [], None
    names = [*KEY, "first", "piece"]

    def shown(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        out = []
        for *key, conv in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv")]):
            if key != node or len(ids) == most:
                if ids:
                    out.append((*node, first, ",".join(ids)))
                node, ids, first = key, [], conv
            ids.append(str(conv))
        yield shown(out)
    if ids:
        yield shown([(*node, first, ",".join(ids))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of every node's pieces, joined by commas, as they come in order."""
    node, digest = None, None
    names = [*KEY, "ends_sha256"]

    def shown(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])], names)

    for batch in batches:
        out = []
        for *key, piece in zip(*[batch.column(c).to_pylist() for c in (*KEY, "piece")]):
            if key == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(piece.encode())
        yield shown(out)
    if node:
        yield shown([(*node, digest.hexdigest())])


def ended(ends: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) of every node at which conversations (conv, depth, hi, lo) end."""
    spark = ends.sparkSession
    order = [*KEY, "conv"]
    key = "depth long, hi long, lo long"
    ranged = ends.select(*order).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    most = PIECE
    pieces = ranged.mapInArrow(lambda batches: _pieces(batches, most), f"{key}, first long, piece string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, f"{key}, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, at, digest, chars, length) of ``conversations`` (conv, length).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; conv_id
    and depth name a node, as conv_id is the least member.
    """
    zero = F.lit(0).cast("long")
    conversations = stored(conversations, "trie_members")
    rows = stored(prefixes(turns), "prefixes")
    held = [F.min("conv").alias("conv"), F.count("*").alias("n_convs")]
    nodes = rows.groupBy(*KEY, "phi", "plo", "chars").agg(*held)
    top = [zero.alias(c) for c in (*KEY, "phi", "plo", "chars")]
    root = conversations.agg(*held).where("n_convs > 0").select(*top, "conv", "n_convs")
    nodes = stored(nodes.unionByName(root), "trie_nodes")
    above = {"depth": F.col("depth") - 1, "hi": F.col("phi"), "lo": F.col("plo")}
    below = nodes.where("depth > 0").select(*[v.alias(k) for k, v in above.items()])
    kids = stored(below.groupBy(*KEY).agg(F.count("*").alias("n_children")), "trie_children")
    valued = nodes.join(kids, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", zero),
        "leaves": F.when(F.col("n_children") > 0, 0).otherwise(1).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("chars"),
    })
    valued = stored(valued, "trie_valued")
    paths = rows.select("conv", *KEY).unionByName(conversations.select("conv", *top[:3]))
    deepest = conversations.agg(F.max("length")).first()[0] or 0
    totals = stored(rolled_up(paths, valued, deepest), "trie_totals")
    over = ["over_depth", "over_hi", "over_lo"]
    parents = nodes.select(*[F.col(k).alias(o) for k, o in zip(KEY, over)], F.col("conv").alias("parent_conv_id"))
    lone = conversations.where("length = 0").select("conv", *top[:3])
    ends = ended(rows.where("depth = length").select("conv", *KEY).unionByName(lone))
    named = valued.withColumns(dict(zip(over, above.values()))).join(parents, over, "left")
    whole = named.join(totals.withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"}), KEY)
    return whole.join(stored(ends, "trie_ends"), KEY, "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
