"""What every job of the engine sets on, and reads through, the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features, ledger
from ..params import Params
from ..sources import derived
from ..sources.storage import measured, stored, stored_all
from .output import comparable

# Adaptive execution picks join strategies from measured sizes and splits
# skewed partitions, also where the split costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A file of a folder per tenant is one task of every later stage: folders of few tenants need several files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

# Set where the session is built: recording the call site of every column
# costs more than planning does.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return clean.clean_all(derived.ledger_sources(tuned(spark), sf_dir))


def cleaned_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The cleaned entities written to the lake and read back.

    Settlement reads each of them several times; from the lake every read is
    pruned to its columns and its size is known when joins are chosen.
    """
    return stored_all(cleaned(spark, sf_dir))


Entities = dict[str, DataFrame]
"""What ``cleaned_tables`` returns; a query that also reads an entity by itself passes them on."""


def facts(spark: SparkSession, sf_dir: str, params: Params = derived.PARAMS, entities: Entities | None = None) -> DataFrame:
    """Fact lines with their six derived values."""
    return features.line_features(ledger.build_facts(entities or cleaned_tables(spark, sf_dir), params))


def fact_table(
    spark: SparkSession, sf_dir: str, params: Params = derived.PARAMS, entities: Entities | None = None
) -> DataFrame:
    """The facts written once, for jobs that read them more than once."""
    return stored(facts(spark, sf_dir, params, entities), "facts")


PLACE = ["ad_client_id", "ad_org_id", "c_bpartner_id", "c_bpartner_location_id"]


def profile_lines(
    spark: SparkSession, sf_dir: str, params: Params = derived.PARAMS, entities: Entities | None = None
) -> DataFrame:
    """What partner values and places are made of, stored: lines without their numbers, which then need not be made."""
    inputs = [
        "paid", "closed_late_invoice", "days_late_closed_invoices_late", "invoice_late_unpaid", *features.SPREADS.values()
    ]
    return stored(facts(spark, sf_dir, params, entities).select(*PLACE, *inputs), "profile_lines")


def full_fact_table(
    spark: SparkSession, sf_dir: str, params: Params = derived.PARAMS, entities: Entities | None = None
) -> DataFrame:
    """Stored facts with the thirty partner values, as the models read them."""
    lines = fact_table(spark, sf_dir, params, entities)
    partners = measured(features.partner_features(lines), "partners")
    return stored(features.with_partner_features(lines, partners), "features")


def shown_partners(lines: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The partner values, or some of them, as they are shown: brought to that form once a partner, not once a line."""
    partners = features.partner_features(lines)
    if columns is not None:
        partners = partners.select(*features.PARTNER_KEY, *columns)
    return measured(comparable(partners), "partners")
