"""Running sums and positions inside groups that may be arbitrarily large.

A plain window puts a whole group into one task. Groups above a size are
therefore range-partitioned by (group, order), summed slice by slice and
shifted by the totals of the slices before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.storage import checkpointed, measured


def _windowed(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    so_far = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.sum(value).over(so_far) for name, value in sums.items()})


def sliced_running_sums(
    df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column], slices: int
) -> DataFrame:
    """Running sums over groups of any size; no task sees more than one slice."""
    ranged = df.repartitionByRange(slices, *[F.col(g) for g in group], *order)
    # The slice number must mean the same rows in both uses below.
    ranged = checkpointed(ranged.withColumn("_slice", F.spark_partition_id()))
    key = [*group, "_slice"]
    local = _windowed(ranged, key, order, sums)
    totals = ranged.groupBy(*key).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *key, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )
    shifted = local.join(offsets, key).withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in sums})
    return shifted.drop("_slice", *[f"_before_{n}" for n in sums])


def running_sums(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    sums: dict[str, Column],
    hot_rows: int,
) -> DataFrame:
    """Inclusive running sums of ``sums`` over ``group`` in ``order``.

    ``order`` must be total inside a group. ``df`` is read more than once, so
    pass a stored table rather than a long lineage.
    """
    sizes = df.groupBy(*group).agg(F.count("*").alias("_rows"))
    # At most rows / hot_rows groups are hot, so this list is short.
    hot = sizes.where(F.col("_rows") > hot_rows)
    hot_total = hot.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    if hot_total == 0:
        return _windowed(df, group, order, sums)
    hot = measured(hot.drop("_rows"), "hot_groups")
    slices = max(2, -(-hot_total // hot_rows))
    large = sliced_running_sums(df.join(hot, group, "left_semi"), group, order, sums, slices)
    small = _windowed(df.join(hot, group, "left_anti"), group, order, sums)
    return small.unionByName(large)


def positions(df: DataFrame, group: list[str], order: list[Column], name: str, hot_rows: int) -> DataFrame:
    """0-based position of every row inside its group."""
    counted = running_sums(df, group, order, {name: F.lit(1).cast("long")}, hot_rows)
    return counted.withColumn(name, F.col(name) - 1)
