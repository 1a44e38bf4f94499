"""Registered queries: cleaning, settlement, facts and partner features."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import clean, features, ledger, partners, settle
from ..sources import derived
from .oracle_base import statement
from .output import comparable, sql_columns
from .session import cleaned, cleaned_tables, fact_table, shown_partners, tuned

P = derived.PARAMS


def _clean(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(cleaned(spark, sf_dir)[entity].drop("created"))


def _due(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    tables = cleaned(spark, sf_dir)
    return tables, settle.due_invoices(tables["c_invoice"], tables["c_paymentterm"], P)


def due_dates_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Due dates that come as text, some of them the null text of the export."""
    tables = cleaned(spark, sf_dir)
    text = "IF(c_invoice_id % 5 = 0, '\\\\N', CAST(duedate AS STRING))"
    due = settle.due_invoices(tables["c_invoice"].withColumn("duedate", F.expr(text)), tables["c_paymentterm"], P)
    return comparable(due.select("ad_client_id", "c_invoice_id", "dateinvoiced", "duedate"))


def _first_stage(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    tables, due = _due(spark, sf_dir)
    return tables, settle.stage1(settle.with_links(due, tables["c_payment"], tables["c_allocationline"]), tables["c_payment"])


def tenant_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.tenants(derived.ledger_sources(tuned(spark), sf_dir)["ad_client"])


def invoices_with_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, due = _due(spark, sf_dir)
    return comparable(
        due.select("ad_client_id", "c_invoice_id", "dateinvoiced", "duedate", "netdays", "duedate_calculated")
    )


def settle_stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = _first_stage(spark, sf_dir)
    return comparable(
        rows.select(
            "ad_client_id", "c_invoice_id", "c_payment_id_paym", "branch", "grandtotal", "paidamt",
            "allocatedamt", "datetrx",
        )
    )


def settle_stage2(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, first = _first_stage(spark, sf_dir)
    rows = settle.stage2(settle.residual(first), tables["c_allocationline"])
    return comparable(
        rows.select(
            "ad_client_id", "c_invoice_id", "c_allocationline_id", "branch", "grandtotal", "paidamt", "amount",
            F.col("alloc_payment_id"), F.col("alloc_cashline_id"),
        )
    )


def settle_stage3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, first = _first_stage(spark, sf_dir)
    rows = settle.stage3(settle.paid_in_installments(first), tables["c_allocationline"])
    return comparable(
        rows.select(
            "ad_client_id", "c_invoice_id", "c_payment_id_paym", "c_allocationline_id", "branch", "amount"
        )
    )


LINE_SPEC = (
    "ad_client_id:i ad_org_id:i dateinvoiced:t c_bpartner_id:i c_invoice_id:i c_bpartner_location_id:i "
    "paymentrule:x grandtotal:m c_payment_id:i c_cashline_id:i duedate:t totalopenamt:m paidamt:m "
    "datetrx:t c_doctype_id:i tendertype:x payamt:m isallocated:x allocatedamt:m c_allocationline_id:i "
    "source_payment_id:i branch:x branch_ord:i"
)


def _line_query(only: set[str] | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = cleaned_tables(spark, sf_dir)
    rows = ledger.classified(tables, P)
    lines = settle.ledger_lines(rows, tables["c_allocationline"], tables["c_payment"], P, only)
    shown = [item.rsplit(":", 1)[0] for item in LINE_SPEC.split()]
    return comparable(lines.withColumnRenamed("c_payment_id_paym", "paym").select(*shown, "paym"))


def ledger_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    identified = ledger.identified_lines(cleaned_tables(spark, sf_dir), P)
    return comparable(
        identified.select("ad_client_id", "src_invoice_id", "c_invoice_id", "branch", "line_no", "line_count", "grandtotal")
    )


def ledger_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants that reach the facts, and whether any of their invoices is split."""
    identified = ledger.identified_lines(cleaned_tables(spark, sf_dir), P)
    return comparable(
        identified.groupBy("ad_client_id")
        .agg(
            F.count("*").alias("line_rows"),
            F.max(F.when(F.col("line_count") > 1, 1).otherwise(0)).alias("has_split_invoices"),
        )
    )


def ledger_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    identified = ledger.identified_lines(cleaned_tables(spark, sf_dir), P)
    return comparable(ledger.profile(identified), digits=2)


FACT_SPEC = (
    "ad_client_id:i ad_org_id:i dateinvoiced:t c_bpartner_id:i c_invoice_id:x c_bpartner_location_id:i "
    "paymentrule:x grandtotal:m duedate:t totalopenamt:m paidamt:m datetrx:t tendertype:x allocatedamt:m "
    "c_allocationline_id:i dayslate:i daystosettle:i late:i paid:i src_invoice_id:i line_no:i branch:x"
)

PARTNER_SPEC = (
    "ad_client_id:i c_bpartner_id:i total_invoices:i closed_invoices_no:i closed_late_invoices_no:i "
    "paid_late_percent:r paid_total:m paid_late_total:m paid_late_raport_percent:r avg_days_paid_late:r "
    "unpaid_invoices_no:i late_unpaid_invoices_no:i late_unpaid_invoices_percent:r unpaid_invoices_sum:m "
    "unpaid_invoices_late_sum:m late_unpaid_invoices_sum_percent:r "
) + " ".join(
    f"max_{s}:m min_{s}:m avg_{s}:r std_{s}:s" for s in features.SPREADS
)

ROW_SPEC = (
    "closed_late_invoice:i paid_late_sum:m days_late_closed_invoices_late:i invoice_late_unpaid:i "
    "unpaid_sum:m unpaid_late_sum:m"
)


def ledger_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(ledger.build_facts(cleaned_tables(spark, sf_dir), P))


def partner_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(partners.build_partner_features(cleaned_tables(spark, sf_dir), P))


def ledger_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fact_table(spark, sf_dir)
    return features.with_partner_features(comparable(lines), shown_partners(lines))


def feature_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fact_table(spark, sf_dir)
    return comparable(features.feature_snapshot(lines, features.partner_features(lines)))


QUERIES = {
    "clean_invoices": partial(_clean, "c_invoice"),
    "clean_payments": partial(_clean, "c_payment"),
    "clean_allocations": partial(_clean, "c_allocationline"),
    "clean_terms": partial(_clean, "c_paymentterm"),
    "tenant_list": tenant_list,
    "invoices_with_terms": invoices_with_terms,
    "due_dates_from_text": due_dates_from_text,
    "settle_stage1": settle_stage1,
    "settle_stage2": settle_stage2,
    "settle_stage3": settle_stage3,
    "ledger_lines": partial(_line_query, None),
    **{f"branch_{b}": partial(_line_query, {b}) for b in settle.BRANCHES},
    "ledger_ids": ledger_ids,
    "ledger_tenants": ledger_tenants,
    "ledger_profile": ledger_profile,
    "ledger_facts": ledger_facts,
    "partner_features": partner_features,
    "ledger_features": ledger_features,
    "feature_snapshot": feature_snapshot,
}

_INVOICES = sql_columns(
    "c_invoice_id:i ad_client_id:i ad_org_id:i dateinvoiced:t c_bpartner_id:i c_bpartner_location_id:i "
    "c_currency_id:i paymentrule:x c_paymentterm_id:i grandtotal:m c_payment_id:i c_cashline_id:i duedate:t "
    "totalopenamt:m paidamt:m"
)
_PAYMENTS = sql_columns(
    "c_payment_id:i ad_client_id:i ad_org_id:i datetrx:t c_doctype_id:i c_bpartner_id:i c_invoice_id:i "
    "tendertype:x c_currency_id:i payamt:m isallocated:x duedate:t allocatedamt:m"
)
_ALLOCATIONS = sql_columns(
    "c_allocationline_id:i ad_client_id:i ad_org_id:i c_invoice_id:i c_bpartner_id:i c_payment_id:i "
    "c_cashline_id:i amount:m"
)
_LINES = sql_columns(LINE_SPEC + " paym:i")

ORACLE = {
    "clean_invoices": statement(f"SELECT {_INVOICES} FROM inv"),
    "clean_payments": statement(f"SELECT {_PAYMENTS} FROM pay"),
    "clean_allocations": statement(f"SELECT {_ALLOCATIONS} FROM alloc"),
    "clean_terms": statement("SELECT c_paymentterm_id, ad_client_id, netdays FROM term"),
    "tenant_list": statement(
        "SELECT DISTINCT ad_client_id FROM c_paymentterm WHERE ad_client_id <> 0 ORDER BY ad_client_id"
    ),
    "invoices_with_terms": statement(
        "SELECT ad_client_id, c_invoice_id, dateinvoiced, duedate, netdays, duedate_calculated FROM invt"
    ),
    "due_dates_from_text": statement(
        "SELECT i.ad_client_id, c_invoice_id, CAST(dateinvoiced AS TIMESTAMP) AS dateinvoiced, "
        "CAST(CASE WHEN c_invoice_id % 5 = 0 THEN dateinvoiced + INTERVAL 1 DAY * CAST(netdays AS INT) ELSE duedate END AS TIMESTAMP) AS duedate "
        "FROM inv i LEFT JOIN term t ON i.c_paymentterm_id = t.c_paymentterm_id AND i.ad_client_id = t.ad_client_id "
        "WHERE c_invoice_id % 5 = 0 OR dateinvoiced <= duedate"
    ),
    "settle_stage1": statement(
        "SELECT "
        + sql_columns(
            "ad_client_id:i c_invoice_id:i c_payment_id_paym:i branch:x grandtotal:m paidamt:m allocatedamt:m datetrx:t"
        )
        + " FROM (SELECT *, paym AS c_payment_id_paym FROM s1)"
    ),
    "settle_stage2": statement(
        "SELECT "
        + sql_columns(
            "ad_client_id:i c_invoice_id:i c_allocationline_id:i branch:x grandtotal:m paidamt:m amount:m "
            "alloc_payment_id:i alloc_cashline_id:i"
        )
        + " FROM (SELECT *, py AS alloc_payment_id, cy AS alloc_cashline_id FROM s2)"
    ),
    "settle_stage3": statement(
        "SELECT "
        + sql_columns("ad_client_id:i c_invoice_id:i c_payment_id_paym:i c_allocationline_id:i branch:x amount:m")
        + " FROM (SELECT *, paym AS c_payment_id_paym FROM s3)"
    ),
    "ledger_lines": statement(f"SELECT {_LINES} FROM lines"),
    **{
        f"branch_{b}": statement(f"SELECT {_LINES} FROM lines WHERE branch = '{b}'") for b in settle.BRANCHES
    },
    "ledger_ids": statement(
        "SELECT "
        + sql_columns("ad_client_id:i src_invoice_id:i c_invoice_id:x branch:x line_no:i line_count:i grandtotal:m")
        + " FROM named"
    ),
    "ledger_tenants": statement(
        "SELECT ad_client_id, count(*) AS line_rows, "
        "CAST(max(CASE WHEN line_count > 1 THEN 1 ELSE 0 END) AS BIGINT) AS has_split_invoices "
        "FROM named GROUP BY 1"
    ),
    "ledger_profile": statement(
        "SELECT ad_client_id, count(DISTINCT c_bpartner_id) AS partners, count(DISTINCT c_invoice_id) AS invoices, "
        "min(dateinvoiced) AS first_invoiced, max(dateinvoiced) AS last_invoiced, "
        "round(CAST(sum(grandtotal) AS DOUBLE), 2) AS billed, round(CAST(sum(allocatedamt) AS DOUBLE), 2) AS settled, "
        "round((CAST(sum(grandtotal) AS DOUBLE) - CAST(sum(allocatedamt) AS DOUBLE)) * 100 "
        "/ CAST(sum(grandtotal) AS DOUBLE), 2) AS unpaid_percent FROM named GROUP BY 1"
    ),
    "ledger_facts": statement(f"SELECT {sql_columns(FACT_SPEC)} FROM facts"),
    "partner_features": statement(f"SELECT {sql_columns(PARTNER_SPEC)} FROM partner"),
    "ledger_features": statement(
        f"SELECT {sql_columns(FACT_SPEC + ' ' + ROW_SPEC + ' ' + PARTNER_SPEC.split('c_bpartner_id:i ', 1)[1])} FROM full_facts"
    ),
    "feature_snapshot": statement(
        "SELECT ad_org_id, c_bpartner_location_id, p.* FROM (SELECT DISTINCT ad_client_id, ad_org_id, c_bpartner_id, "
        f"c_bpartner_location_id FROM facts) f JOIN (SELECT {sql_columns(PARTNER_SPEC)} FROM partner) p "
        "USING (ad_client_id, c_bpartner_id)"
    ),
}
