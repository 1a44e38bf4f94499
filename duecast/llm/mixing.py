"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. The whole part of target / size is
given to all its documents as certain copies; the rest is an order sample: each
document draws a fixed random number U and is ranked by

    (U / (1 - U)) / (inclusion odds),

and the documents of lowest rank are taken until their words reach the rest. The
sample has a fixed size in words, so a source misses its target by at most half
a document, also where many rows are the same: of those at the cut as many are taken as fit. The inclusion odds are those of the source's remaining share times
the document's size over the mean size of its source, so that the sample is one
of unequal probabilities; a document of no words takes no part in it.

The cut of a source is found without sorting it: rank bins, about as many as
the root of its rows, are summed, and only the bin with the cut is ordered. The
cuts are a table with one row per source.

Cases: a null text has no words; a null source is a source of its own, last in
order; U depends on identifier and text alone, so reruns agree and the order of
rows does not matter; of rows equal in identifier, source and text some may be taken once more
than the others; a source or a table without words gives targets of 0; an empty table
stays empty; columns named like the added ones (``size``, ``source_size``,
``target``, ``copies``) are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.positions import positions
from ..sources.storage import stored
from .common import WORD, body, kept, packed, uniform, unpacked

HOT_ROWS = 1_000_000
ADDED = ["size", "source_size", "target", "copies"]
SOURCE = ["_source", "_unknown"]
SEED = 9


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``target`` of every source: weights in code point order, capped at ``most`` times its size.

    What exceeds a cap is shared again by weight. Each pass is an aggregation of
    one row per source and caps at least one of them; two or three are usual.
    """
    ordered = positions(
        sizes.withColumn("_all", F.lit(0)), ["_all"], [F.col("_unknown"), F.col("_source")], "_at", HOT_ROWS
    ).drop("_all")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    ordered = stored(ordered.withColumn("_weight", weight), "source_weights")
    total = ordered.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("_weight") * level > most * F.col("source_size")
        free = ordered.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if not free["weight"]:
            break
        next_level = (share * total - most * free["full"]) / free["weight"]
        if next_level == level:
            break
        level = next_level
    capped = F.least(F.col("_weight") * (level or 0.0), F.lit(most) * F.col("source_size"))
    return ordered.withColumn("target", capped.cast("double")).drop("_at", "_weight")


def _ranked(rows: DataFrame) -> DataFrame:
    """``_rank``: random odds over inclusion odds; ``_spot``: the same in (0, 1)."""
    part = F.col("_rest") / F.col("source_size")
    odds = part / (1 - part) * F.col("size") / (F.col("source_size") / F.col("_docs"))
    drawn = uniform(F.col("_id"), F.col("_text"), F.lit(SEED))
    rank = F.when((F.col("_rest") > 0) & (F.col("size") > 0), drawn / (1 - drawn) / odds)
    return rows.withColumn("_rank", rank).withColumn("_spot", F.col("_rank") / (1 + F.col("_rank")))


def _place() -> Column:
    return F.struct(F.col("_rank"), F.col("_id"), F.col("_text"))


def cuts(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its size, target, whole copies and the place of the last sampled document."""
    sizes = sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    plan = targets(sizes, weights, share, most)
    plan = plan.withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    plan = stored(plan.withColumn("_bins", 4 * F.ceil(F.sqrt("_docs"))), "source_plan")

    ranked = _ranked(sized.join(plan, SOURCE)).where("_rank is not null")
    ranked = ranked.withColumn("_bin", F.floor(F.col("_spot") * F.col("_bins")))
    bins = ranked.groupBy(*SOURCE, "_bin").agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest"))
    before = Window.partitionBy(*SOURCE).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    # The cut lies in the last bin that starts below the rest.
    edge = bins.where("_before <= _rest").groupBy(*SOURCE).agg(F.max(F.struct("_bin", "_before")).alias("_edge"))
    edge = stored(edge.select(*SOURCE, F.col("_edge._bin").alias("_bin"), F.col("_edge._before").alias("_start")), "source_edges")
    # Rows that are the same are one line of the bin, whatever their number.
    inside = ranked.join(edge, [*SOURCE, "_bin"]).groupBy(*SOURCE, "_rank", "_id", "_text", "size", "_start", "_rest").agg(
        F.count("*").alias("_same")
    )
    order = Window.partitionBy(*SOURCE).orderBy(_place()).rowsBetween(Window.unboundedPreceding, -1)
    sums = F.sum(F.col("size") * F.col("_same")).over(order)
    inside = inside.withColumn("_before", F.col("_start") + F.coalesce(sums, F.lit(0)))
    # A row is taken if its middle lies within the rest.
    fits = F.floor((F.col("_rest") - F.col("_before")) / F.col("size") + 0.5)
    chosen = inside.withColumn("_fits", F.least(fits, F.col("_same"))).where("_fits > 0")
    last = chosen.groupBy(*SOURCE).agg(F.max(F.struct(_place().alias("place"), "_fits", "_same")).alias("_cut"))
    last = last.select(*SOURCE, F.col("_cut.place").alias("_last"), "_cut._fits", "_cut._same")
    cut = plan.join(edge, SOURCE, "left").join(last, SOURCE, "left")
    return stored(cut.withColumnRenamed("_bin", "_edge").drop("_start"), "source_cuts")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix takes a row.

    Only (identifier, source, size, text hash) is stored and aggregated; texts
    meet the table of cuts, one row per source, which is broadcast if small.
    """
    columns = kept(docs, ADDED)
    own = lambda name: F.col("row").getField(name)
    sized = packed(docs, columns).withColumns(
        {
            "size": words(body(own(text))),
            "_id": own(key).cast("string"),
            "_text": F.xxhash64(own(text)),
            "_source": F.coalesce(own(source), F.lit("")),
            "_unknown": own(source).isNull(),
        }
    )
    narrow = stored(sized.select("_id", "_text", *SOURCE, "size"), "document_sizes")
    cut = cuts(narrow, weights, share, most)
    ranked = _ranked(sized.join(cut, SOURCE))
    bin_of = F.floor(F.col("_spot") * F.col("_bins"))
    sampled = F.when(F.col("_rank").isNull(), False).otherwise(
        F.coalesce((bin_of < F.col("_edge")) | (bin_of == F.col("_edge")) & (_place() <= F.col("_last")), F.lit(False))
    )
    shown = lambda rows, taken: rows.select(
        *unpacked(columns), "size", "source_size", "target", (F.col("_whole").cast("long") + taken.cast("long")).alias("copies")
    )
    if cut.where("_fits < _same").isEmpty():
        return shown(ranked, sampled)
    # Of the same rows at a cut only some are taken; they are numbered as they come.
    tied = F.coalesce((F.col("_fits") < F.col("_same")) & (_place() == F.col("_last")), F.lit(False))
    same = stored(ranked.where(tied).withColumn("_at", F.monotonically_increasing_id()), "rows_at_cuts")
    nth = positions(same, SOURCE, [F.col("_at")], "_nth", HOT_ROWS)
    return shown(ranked.where(~tied), sampled).unionByName(shown(nth, F.col("_nth") < F.col("_fits")))


def copied(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of a mix: each as often as it is taken."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    taken = mixed.where("copies > 0").select(F.explode(F.array_repeat(row, F.col("copies").cast("int"))).alias("row"))
    return taken.select(*unpacked(list(columns)))
