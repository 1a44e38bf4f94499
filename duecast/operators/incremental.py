"""Incremental loads: high-water marks, rows after them, insert-only merge, upsert."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions.columns import moment
from ..params import Params
from ..schemas import KEY
from ..sources import lake
from ..sources.storage import measured, stored
from . import clean
from .stats import SUFFIX


def high_water_marks(stats: DataFrame) -> DataFrame:
    """Per tenant and entity, the last run that kept any row."""
    pairs = ", ".join(f"'{entity}', no_clean_entries_{suffix}" for entity, suffix in SUFFIX.items())
    kept = stats.selectExpr("ad_client_id", "date_run", f"stack({len(SUFFIX)}, {pairs}) AS (entity, kept_rows)")
    return kept.where("kept_rows > 0").groupBy("ad_client_id", "entity").agg(
        F.max("date_run").alias("high_water_mark")
    )


def _oldest_mark(own: DataFrame, tenants: DataFrame) -> datetime | None:
    """The mark that all listed tenants have reached; none if one of them has no mark."""
    if not tenants.join(own, "ad_client_id", "left_anti").isEmpty():
        return None
    return own.join(tenants, "ad_client_id", "left_semi").agg(F.min("high_water_mark")).first()[0]


def rows_after(
    df: DataFrame, marks: DataFrame, entity: str, params: Params, tenants: DataFrame | None = None
) -> DataFrame:
    """Rows changed after their tenant's mark; all rows of a tenant without one.

    With a list of ``tenants`` only their rows are read, and the scan itself
    skips what is older than every mark.
    """
    own = measured(marks.where(F.col("entity") == entity).select("ad_client_id", "high_water_mark"), "marks")
    if tenants is not None:
        df = df.join(tenants, "ad_client_id", "left_semi")
        oldest = _oldest_mark(own, tenants)
        if oldest is not None:
            df = df.where(F.col(params.change_column) > moment(oldest))
    joined = df.join(own, "ad_client_id", "left")
    newer = F.col("high_water_mark").isNull() | (F.col(params.change_column) > F.col("high_water_mark"))
    return joined.where(newer).drop("high_water_mark")


def newest(batch: DataFrame, key: list[str], change_column: str) -> DataFrame:
    """One row per key: the last changed, and of equal ones the greatest in all its values.

    Keys alone are counted first; only rows whose key comes again are compared. ``batch`` is read more than once.
    """
    counted = batch.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    repeated = measured(counted, "repeated_keys")
    if repeated.isEmpty():
        return batch
    same = reduce(lambda a, b: a & b, [batch[c].eqNullSafe(repeated[c]) for c in key])
    own = batch.join(repeated, same, "left_semi")
    rest = batch.join(repeated, same, "left_anti")
    return rest.unionByName(last_of(own, key, change_column))


def last_of(batch: DataFrame, key: list[str], change_column: str) -> DataFrame:
    order = [c for c in batch.columns if c == change_column] + [c for c in batch.columns if c not in (change_column, *key)]
    chosen = batch.groupBy(*key).agg(F.max(F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in batch.columns])


def new_rows(batch: DataFrame, target: DataFrame | None, key: list[str], change_column: str = "created") -> DataFrame:
    """The batch rows whose key the target does not hold yet, each key once, the newest.

    The target is only searched for the keys of the batch. A batch that is
    small next to it is broadcast, and the target is not shuffled.
    """
    batch = newest(batch, key, change_column)
    if target is None:
        return batch
    batch = stored(batch, "batch")
    known = measured(target.select(*key).join(batch.select(*key), key, "left_semi"), "known_keys")
    return batch.join(known, key, "left_anti")


def changes(batch: DataFrame, entity: str, change_column: str) -> DataFrame:
    """The last change of every key, cleaned, with ``_gone`` where the row is none that is kept."""
    last = newest(batch, KEY[entity], change_column)
    kept = clean.clean(entity, last).withColumn("_gone", F.lit(False))
    lost = last.where(f"NOT coalesce({clean.KEPT[entity]}, false)")
    return kept.unionByName(lost.select(*[F.col(c) for c in kept.columns if c != "_gone"], F.lit(True).alias("_gone")))


def upsert(batch: DataFrame, entity: str, run: lake.Run, name: str, schema: StructType, change_column: str) -> None:
    """Puts the last change of every key into a table dealt over buckets of its key.

    Only buckets that hold a changed key are read and written anew. Of the held row and the change of a key
    the later one stays, the change if they are of the same time; a change that cleaning
    leaves out, such as a voided document, takes the held row away.
    """
    key = KEY[entity]
    new = stored(changes(batch, entity, change_column).withColumn(lake.BUCKET, lake.bucket_of(key)), "changes")
    touched = {r[0] for r in new.select(lake.BUCKET).distinct().collect()}  # at most lake.BUCKETS
    if not touched:
        return
    held = run.read(name, schema, touched).withColumns({"_gone": F.lit(False), "_new": F.lit(0)})
    both = held.unionByName(new.drop(lake.BUCKET).withColumn("_new", F.lit(1)))
    order = F.struct(change_column, "_new", *[c for c in schema.fieldNames() if c not in (change_column, *key)], "_gone")
    chosen = both.groupBy(*key).agg(F.max(order).alias("_row")).where("NOT _row._gone")
    rows = chosen.select(*[F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in schema.fieldNames()])
    run.drop(name, touched)
    run.put(name, rows, key, instead=False)
