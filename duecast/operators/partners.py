"""Partner features straight from the cleaned tables.

The ledger holds a line for every (payment, allocation) pair of an invoice
paid in instalments. The features need only sums over those lines, and such a
sum factors into sums over the payments and sums over the allocations. So no
pair is made here, and no line has to be numbered.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import floor_days
from ..params import Params
from . import features, ledger, settle


def installment_sums(classified: DataFrame, allocations: DataFrame) -> DataFrame:
    """What the instalment lines of each invoice add up to, per partner key.

    A pair is a paid line over the allocation's amount. Without a cash line it
    carries the payment's date and drops out if that lies before the invoice;
    with one it is settled on the day of the invoice and never late.
    """
    rows = settle.paid_in_installments(classified).withColumn(
        "dayslate", floor_days(F.col("datetrx"), F.col("duedate"))
    )
    on_time = f"NOT {settle.IN_ADVANCE}"
    late = f"{on_time} AND dayslate > 0"
    payments = rows.groupBy(*settle.INVOICE_KEY, "c_bpartner_id").agg(
        F.expr("count(*) AS every"),
        F.expr(f"count_if({on_time}) AS dated"),
        F.expr(f"count_if({late}) AS late"),
        F.expr(f"sum(IF({late}, dayslate, 0)) AS days"),
    )
    kinds = {"p": "c_cashline_id = 0", "c": "c_cashline_id <> 0"}
    amounts = []
    for kind, condition in kinds.items():
        own = f"IF({condition}, amount, NULL)"
        amounts += [
            f"count_if({condition}) AS n_{kind}",
            f"coalesce(sum({own}), 0) AS sum_{kind}",
            f"coalesce(sum({own} * {own}), 0) AS sq_{kind}",
            f"max({own}) AS max_{kind}",
            f"min({own}) AS min_{kind}",
        ]
    allocated = allocations.groupBy(*settle.INVOICE_KEY).agg(*[F.expr(a) for a in amounts])
    joined = payments.join(allocated, settle.INVOICE_KEY).selectExpr(
        "*", "dated * n_p + every * n_c AS lines", "late * n_p AS late_lines"
    ).where("lines > 0")
    zero = "IF(lines > late_lines, 0, NULL)"
    values = {
        "lines": "lines", "closed": "lines", "closed_late": "late_lines", "late_lines": "late_lines",
        "late_days": "days * n_p", "late_unpaid": "0",
        "sum_paid": "dated * sum_p + every * sum_c",
        "sq_paid": "dated * sq_p + every * sq_c",
        "max_paid": "greatest(IF(dated > 0, max_p, NULL), max_c)",
        "min_paid": "least(IF(dated > 0, min_p, NULL), min_c)",
        "sum_late_paid": "late * sum_p",
        "sq_late_paid": "late * sq_p",
        "max_late_paid": f"greatest(IF(late > 0, max_p, NULL), {zero})",
        "min_late_paid": f"least(IF(late > 0, min_p, NULL), {zero})",
    }
    for suffix in features.SPREADS:
        values[f"n_{suffix}"] = "lines"
        for part in ("sum", "sq", "max", "min"):
            values.setdefault(f"{part}_{suffix}", "0")
    return features.as_sums(joined, values)


def build_partner_features(cleaned: dict[str, DataFrame], params: Params) -> DataFrame:
    """The thirty values of every partner, without building the ledger."""
    if params.require_split_invoices:
        return features.partner_features(features.line_features(ledger.build_facts(cleaned, params)))
    payments, allocations = cleaned["c_payment"], cleaned["c_allocationline"]
    rows = ledger.classified(cleaned, params)
    lines = settle.ledger_lines(rows, allocations, payments, replace(params, dedupe_installments=True))
    sums = features.partner_sums(features.line_features(ledger.dated_lines(lines, params)))
    if not params.dedupe_installments:
        sums = features.merged_sums(sums.unionByName(installment_sums(rows, allocations)))
    return features.features_of_sums(sums)
