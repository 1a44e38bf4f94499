"""Cleaning of the four source entities, all tenants at once."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from ..sources.storage import measured

SYSTEM_TENANT = 0

# What the scan itself filters: only real tenants, only sales invoices.
SCANNED = {
    "c_invoice": f"ad_client_id <> {SYSTEM_TENANT} AND issotrx = 'Y'",
    "c_payment": f"ad_client_id <> {SYSTEM_TENANT}",
    "c_allocationline": f"ad_client_id <> {SYSTEM_TENANT}",
    "c_paymentterm": f"ad_client_id <> {SYSTEM_TENANT}",
}

# Which scanned rows are kept: completed documents that are not returns,
# completed receipts, and allocations from customers (negative ones pay suppliers).
KEPT = {
    "c_invoice": "docstatus = 'CO' AND isreturntrx = 'N'",
    "c_payment": "isreceipt = 'Y' AND docstatus = 'CO'",
    "c_allocationline": "amount > 0",
    "c_paymentterm": "true",
}

USED_UP = {"c_invoice": ["issotrx", "docstatus", "isreturntrx"], "c_payment": ["isreceipt", "docstatus"]}

NULLABLE_IDS = {
    "c_invoice": ["c_payment_id", "c_cashline_id"],
    "c_payment": ["c_invoice_id", "c_bpartner_id"],
}


def clean(entity: str, df: DataFrame) -> DataFrame:
    """The kept rows of one entity, without its flags, with null ids as 0."""
    kept = df.where(f"{SCANNED[entity]} AND {KEPT[entity]}").drop(*USED_UP.get(entity, []))
    ids = [c for c in kept.columns if c.endswith("id")]
    zeroed = set(ids if entity == "c_allocationline" else NULLABLE_IDS.get(entity, []))
    return kept.selectExpr(
        *[
            f"CAST({f'coalesce({c}, 0)' if c in zeroed else c} AS BIGINT) AS {c}" if c in ids else c
            for c in kept.columns
        ]
    )


CLEANERS = {entity: partial(clean, entity) for entity in KEPT}


def clean_all(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {entity: clean(entity, sources[entity]) for entity in KEPT}


def tenants(df: DataFrame) -> DataFrame:
    """The tenants to process, in order."""
    listed = df.select("ad_client_id").distinct().where(f"ad_client_id <> {SYSTEM_TENANT}")
    return listed.orderBy("ad_client_id")


def settleable_invoices(cleaned: dict[str, DataFrame]) -> DataFrame:
    """Invoices of tenants that also have payments and allocations."""
    with_payments, with_allocations = (
        cleaned[other].select("ad_client_id").distinct() for other in ("c_payment", "c_allocationline")
    )
    present = measured(with_payments.intersect(with_allocations), "tenants")
    return cleaned["c_invoice"].join(present, "ad_client_id", "left_semi")
