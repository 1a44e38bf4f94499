"""From ledger lines to fact rows: line ids, lateness, paid flag, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import floor_days, is_true, moment, zero_if_null
from ..params import Params
from ..schemas import FACT_LINE
from ..sources.storage import measured, stored
from . import clean, positions, settle

LINE_ORDER = ["branch_ord", "c_allocationline_id", "source_payment_id"]


def crowded_invoices(rows: DataFrame, params: Params) -> DataFrame:
    """Invoices that may get more lines than one task should number.

    p payments and a allocations give at most (p + 1) * (a + 1) + 1 lines; the
    classified ``rows`` carry both numbers.
    """
    may_hold = (F.col("n_payments") + 1) * (F.col("n_allocations") + 1) + 1
    crowded = rows.where(may_hold > params.hot_group_rows).select(*settle.INVOICE_KEY).distinct()
    return measured(crowded, "crowded_invoices")


def numbered_lines(lines: DataFrame, crowded: DataFrame, params: Params) -> DataFrame:
    """``line_no`` (0-based) and ``line_count`` inside each invoice."""
    order = [F.col(c) for c in LINE_ORDER]
    invoice = Window.partitionBy(*settle.INVOICE_KEY)

    def in_one_task(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "line_no": F.row_number().over(invoice.orderBy(*order)).cast("long") - 1,
                "line_count": F.count("*").over(invoice),
            }
        )

    if crowded.isEmpty():
        return in_one_task(lines)
    # Read several times from here on: twice below, and again to find the slices.
    lines = stored(lines, "lines")
    few = in_one_task(lines.join(crowded, settle.INVOICE_KEY, "left_anti"))
    many = lines.join(crowded, settle.INVOICE_KEY, "left_semi")
    many = positions.positions(many, settle.INVOICE_KEY, order, "line_no", params.hot_group_rows)
    counts = many.groupBy(*settle.INVOICE_KEY).agg(F.count("*").alias("line_count"))
    return few.unionByName(many.join(counts, settle.INVOICE_KEY))


def line_ids(numbered: DataFrame) -> DataFrame:
    """A text id per line: the invoice id, with the line number if it was split."""
    text = F.col("c_invoice_id").cast("string")
    split = F.concat_ws("_", text, F.col("line_no").cast("string"))
    return numbered.withColumn("src_invoice_id", F.col("c_invoice_id")).withColumn(
        "c_invoice_id", F.when(F.col("line_count") > 1, split).otherwise(text)
    )


def dated_lines(lines: DataFrame, params: Params) -> DataFrame:
    """Lines after advance payments and empty lines, with lateness and flags."""
    kept = lines.where(
        ~is_true(F.col("datetrx") < F.col("dateinvoiced")) & (F.col("grandtotal") > 0)
    )
    settled_at = F.coalesce(F.col("datetrx"), moment(params.as_of))
    open_amount = F.col("grandtotal") - F.col("paidamt")
    tolerance = F.lit(params.paid_tolerance).cast("decimal(3,2)")
    return kept.withColumns(
        {
            "dayslate": F.greatest(floor_days(settled_at, F.col("duedate")), F.lit(0).cast("long")),
            "daystosettle": floor_days(F.col("datetrx"), F.col("dateinvoiced")),
            "paid": F.when(open_amount <= tolerance, 1).otherwise(0),
        }
    ).withColumn("late", F.when(F.col("dayslate") > 0, 1).otherwise(0))


def fact_lines(identified: DataFrame, params: Params) -> DataFrame:
    return dated_lines(identified, params).select(*FACT_LINE, "src_invoice_id", "line_no", "branch")


def classified(cleaned: dict[str, DataFrame], params: Params) -> DataFrame:
    return settle.classified(
        clean.settleable_invoices(cleaned),
        cleaned["c_allocationline"],
        cleaned["c_payment"],
        cleaned["c_paymentterm"],
        params,
    )


def identified_lines(cleaned: dict[str, DataFrame], params: Params) -> DataFrame:
    rows = classified(cleaned, params)
    lines = settle.ledger_lines(rows, cleaned["c_allocationline"], cleaned["c_payment"], params)
    return line_ids(numbered_lines(lines, crowded_invoices(rows, params), params))


def build_facts(cleaned: dict[str, DataFrame], params: Params) -> DataFrame:
    """Cleaned tables to fact lines, all tenants in one job."""
    identified = identified_lines(cleaned, params)
    if params.require_split_invoices:
        split = measured(identified.where(F.col("line_count") > 1).select("ad_client_id").distinct(), "split_tenants")
        identified = identified.join(split, "ad_client_id", "left_semi")
    return fact_lines(identified, params)


def profile(identified: DataFrame) -> DataFrame:
    """Per tenant: partners, invoices, date range and the unpaid percentage."""
    billed = zero_if_null(F.sum("grandtotal")).cast("double")
    settled = zero_if_null(F.sum("allocatedamt")).cast("double")
    # Distinct counts in two steps, so that a large tenant stays spread out.
    partners = (
        identified.select("ad_client_id", "c_bpartner_id").distinct()
        .groupBy("ad_client_id").agg(F.count("*").alias("partners"))
    )
    rest = identified.groupBy("ad_client_id").agg(
        # Line ids are unique inside a tenant, so counting them needs no distinct.
        F.count("c_invoice_id").alias("invoices"),
        F.min("dateinvoiced").alias("first_invoiced"),
        F.max("dateinvoiced").alias("last_invoiced"),
        billed.alias("billed"),
        settled.alias("settled"),
        F.round(F.try_divide((billed - settled) * 100, billed), 2).alias("unpaid_percent"),
    )
    return rest.join(partners, "ad_client_id")
