"""Statistics of a cleaning run, one row per tenant."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import moment
from ..schemas import CLEANING_STATS
from .clean import KEPT, SCANNED

# Column suffix of each entity in the statistics table (fixed values).
SUFFIX = {
    "c_invoice": "invoices",
    "c_allocationline": "alloc",
    "c_payment": "payments",
    "c_paymentterm": "terms",
}


def entity_counts(entity: str, source: DataFrame, by: list[str]) -> DataFrame:
    """Rows read and rows kept, in one pass over the source."""
    suffix = SUFFIX[entity]
    return (
        source.where(SCANNED[entity])
        .groupBy(*by)
        .agg(
            F.count("*").alias(f"no_entries_{suffix}"),
            F.expr(f"count_if({KEPT[entity]})").alias(f"no_clean_entries_{suffix}"),
        )
    )


def _percent(suffix: str) -> str:
    kept, read = f"no_clean_entries_{suffix}", f"no_entries_{suffix}"
    return f"IF({kept} <> 0, {kept} / {read} * 100, 0D)"


def cleaning_stats(
    sources: dict[str, DataFrame],
    tenants: DataFrame,
    facts: DataFrame,
    date_run: datetime,
    runtime_in_seconds: float = 0.0,
) -> DataFrame:
    """Rows read and kept per entity, percentages, and the number of facts."""
    table = tenants
    for entity in SUFFIX:
        table = table.join(entity_counts(entity, sources[entity], ["ad_client_id"]), "ad_client_id", "left")
    rows = facts.groupBy("ad_client_id").agg(F.count("*").alias("no_total_aggregated_rows"))
    table = table.join(rows, "ad_client_id", "left").fillna(0)
    percents = [f"{_percent(s)} AS {s}_remaining_percent" for s in SUFFIX.values()]
    table = table.selectExpr("*", *percents).selectExpr(
        "*",
        "(invoices_remaining_percent + alloc_remaining_percent + terms_remaining_percent"
        " + payments_remaining_percent) / 4 AS avg_remaining_percent",
    )
    table = table.withColumns(
        {
            "date_run": moment(date_run),
            "runtime_in_seconds": F.lit(float(runtime_in_seconds)),
        }
    )
    return table.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in CLEANING_STATS])
