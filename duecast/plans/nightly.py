"""The nightly run: load what is new, rebuild the facts, record statistics, publish all of it at once."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import moment
from ..operators import clean, features, incremental, ledger, quarantine, stats
from ..params import Params
from ..schemas import CLEANING_STATS, KEY, SOURCES
from ..sources.lake import Lake, Run
from ..sources.storage import measured, side_by_side, stored

STATUS = "ad_client_id long, date_run timestamp_ntz, step string, ok int, result_rows long, message string"


def read_batch(
    source: DataFrame, entity: str, run_stats: DataFrame | None, tenants: DataFrame, params: Params
) -> DataFrame:
    """The rows this run reads of one entity, stored: listed tenants, after their marks."""
    if run_stats is None:
        rows = source.join(tenants, "ad_client_id", "left_semi")
    else:
        rows = incremental.rows_after(source, incremental.high_water_marks(run_stats), entity, params, tenants)
    return stored(quarantine.conformed(entity, rows, params.change_column), "batch")


def cleaned_schema(spark: SparkSession, entity: str, rows: DataFrame | None = None) -> T.StructType:
    return clean.clean(entity, spark.createDataFrame([], SOURCES[entity]) if rows is None else rows).schema


def cleaned_table(lake: Lake | Run, spark: SparkSession, entity: str) -> DataFrame:
    return lake.read(f"{entity}_cleaned", cleaned_schema(spark, entity))


def load_entity(batch: DataFrame, entity: str, run: Run, params: Params) -> DataFrame:
    """Clean a batch and put it into the cleaned table; returns the whole table.

    Marked by creation, rows are added if their key is not held; marked by change, the last change of a key stays.
    """
    name, key = f"{entity}_cleaned", KEY[entity]
    spark = batch.sparkSession
    schema = cleaned_schema(spark, entity, batch)
    if params.change_column == "created":
        cleaned = clean.clean(entity, batch)
        held = run.read(name, schema) if run.holds(name) else None
        run.put(name, incremental.new_rows(cleaned, held, key, params.change_column), key, instead=False)
    else:
        incremental.upsert(batch, entity, run, name, schema, params.change_column)
    return run.read(name, schema)


def status_rows(recorded: DataFrame, tenants: DataFrame, rejected: DataFrame, date_run: datetime) -> DataFrame:
    """Per tenant and step whether it went well in this run, with the rows it gave or what was wrong."""
    steps = recorded.selectExpr(
        "ad_client_id",
        "stack(2, 'cleaning', least(no_clean_entries_invoices, no_clean_entries_alloc, no_clean_entries_payments, "
        "no_clean_entries_terms), 'aggregation', no_total_aggregated_rows) AS (step, result_rows)",
    )
    kinds = rejected.groupBy("ad_client_id", "entity", "rule", "column_name").agg(F.count("*").alias("n"))
    reasons = kinds.groupBy("ad_client_id").agg(
        F.sum("n").alias("rejected"),
        F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "entity", "rule", "column_name", "n"))), "; ").alias("why"),
    )
    listed = tenants.selectExpr("ad_client_id", "explode(array('cleaning', 'aggregation')) AS step")
    joined = listed.join(steps, ["ad_client_id", "step"], "left").join(reasons, "ad_client_id", "left")
    return joined.select(
        "ad_client_id",
        moment(date_run).alias("date_run"),
        "step",
        F.expr("IF(rejected IS NULL AND coalesce(result_rows, 0) > 0, 1, 0) AS ok"),
        F.expr("IF(rejected IS NULL, coalesce(result_rows, 0), 0) AS result_rows"),
        F.expr("CASE WHEN rejected IS NOT NULL THEN concat('rejected: ', why) WHEN coalesce(result_rows, 0) = 0 THEN 'no rows' END AS message"),
    )


def run(
    sources: dict[str, DataFrame],
    root: str,
    params: Params,
    date_run: datetime,
    progress: Callable[[str], None] = lambda step: None,
) -> DataFrame:
    """One run over the listed tenants; returns the statistics of all runs so far.

    Every source is read once. What the statistics count as read and kept, and
    so the marks that the next run starts from, is the batch of this run. A tenant with rejected rows takes no
    part: nothing of it is loaded, its marks and facts stay as they were. ``progress`` is told each step; a
    run that ends early, for whatever reason, leaves the lake as it was.
    """
    started = time.monotonic()
    spark = sources["c_invoice"].sparkSession
    lake = Lake(spark, root)
    work = lake.begin()
    tenants = measured(clean.tenants(sources["ad_client"]), "tenants")
    run_stats = lake.read("cleaning_stats", CLEANING_STATS) if lake.numbers() else None
    wanted = {entity: sources[entity] for entity in clean.KEPT}
    batches = side_by_side(wanted, lambda entity, source: read_batch(source, entity, run_stats, tenants, params))
    progress("read")
    batches, rejected = quarantine.split(batches)
    rejected = stored(rejected, "rejected")
    failed = measured(rejected.select("ad_client_id").distinct(), "failed_tenants")
    batches = {entity: rows.join(failed, "ad_client_id", "left_anti") for entity, rows in batches.items()}
    good = measured(tenants.join(failed, "ad_client_id", "left_anti"), "good_tenants")
    cleaned = side_by_side(batches, lambda entity, batch: load_entity(batch, entity, work, params))
    progress("cleaned")
    lines = stored(features.line_features(ledger.build_facts(cleaned, params)), "facts")
    partners = measured(features.partner_features(lines), "partners")
    work.replace("facts", features.with_partner_features(lines, partners), ["ad_client_id"])
    progress("facts")
    recorded = stored(stats.cleaning_stats(batches, good, lines, date_run, time.monotonic() - started), "recorded")
    work.append("cleaning_stats", recorded)
    work.append("run_status", status_rows(recorded, tenants, rejected, date_run))
    work.append("rejected_rows", rejected.withColumn("date_run", moment(date_run)))
    progress("recorded")
    work.commit()
    return lake.read("cleaning_stats", CLEANING_STATS)
