"""Payment behaviour: six values per line and thirty per business partner."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PARTNER_KEY = ["ad_client_id", "c_bpartner_id"]

# Which line amount each family of extremes and averages describes.
SPREADS = {
    "paid": "allocatedamt",
    "late_paid": "paid_late_sum",
    "unpaid": "unpaid_sum",
    "late_unpaid": "unpaid_late_sum",
}


def line_features(facts: DataFrame) -> DataFrame:
    """The six per-line values."""
    first = facts.selectExpr(
        "*",
        "IF(late = 1 AND paid = 1, 1, 0) AS closed_late_invoice",
        "CAST(allocatedamt * late AS DECIMAL(18,2)) AS paid_late_sum",
        "late * (1 - paid) AS invoice_late_unpaid",
        "CAST(grandtotal - paidamt AS DECIMAL(18,2)) AS unpaid_sum",
    )
    return first.selectExpr(
        "*",
        "dayslate * closed_late_invoice AS days_late_closed_invoices_late",
        "CAST(unpaid_sum * late AS DECIMAL(18,2)) AS unpaid_late_sum",
    )


def _ratio(part: str, whole: str) -> str:
    """Null where the division has no finite result."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


# What a partner's lines add up to. Every column can be added up again, so sums
# of parts of the lines can be merged.
COUNTS = ["lines", "closed", "closed_late", "late_days", "late_lines", "late_unpaid"]
SUM_TYPES = {c: "BIGINT" for c in COUNTS} | {
    f"{part}_{suffix}": kind
    for suffix in SPREADS
    for part, kind in (
        ("n", "BIGINT"), ("sum", "DECIMAL(38,2)"), ("sq", "DECIMAL(38,4)"),
        ("max", "DECIMAL(18,2)"), ("min", "DECIMAL(18,2)"),
    )
}


def as_sums(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """The partner key and the sums, each given as an expression."""
    return df.selectExpr(*PARTNER_KEY, *[f"CAST({values[c]} AS {kind}) AS {c}" for c, kind in SUM_TYPES.items()])


def partner_sums(lined: DataFrame) -> DataFrame:
    """One aggregation per partner.

    Every aggregate has a partial form, so a partner that holds much of the
    data is reduced before the shuffle. Money is summed exactly, its squares
    too, so the result does not depend on the order of the rows.
    """
    aggregates = {
        "lines": "count(*)",
        "closed": "count_if(paid = 1)",
        "closed_late": "sum(CAST(closed_late_invoice AS BIGINT))",
        "late_days": "sum(days_late_closed_invoices_late)",
        "late_lines": "count_if(days_late_closed_invoices_late <> 0)",
        "late_unpaid": "sum(CAST(invoice_late_unpaid AS BIGINT))",
    }
    for suffix, amount in SPREADS.items():
        aggregates |= {
            f"n_{suffix}": f"count({amount})",
            f"sum_{suffix}": f"coalesce(sum({amount}), 0)",
            f"sq_{suffix}": f"coalesce(sum({amount} * {amount}), 0)",
            f"max_{suffix}": f"max({amount})",
            f"min_{suffix}": f"min({amount})",
        }
    grouped = lined.groupBy(*PARTNER_KEY).agg(*[F.expr(v).alias(c) for c, v in aggregates.items()])
    return as_sums(grouped, {c: c for c in SUM_TYPES})


def merged_sums(parts: DataFrame) -> DataFrame:
    """Sums of several parts of a partner's lines put together."""

    def merge(column: str) -> str:
        rule = column.split("_")[0]
        return f"{rule if rule in ('max', 'min') else 'sum'}({column})"

    grouped = parts.groupBy(*PARTNER_KEY).agg(*[F.expr(merge(c)).alias(c) for c in SUM_TYPES])
    return as_sums(grouped, {c: c for c in SUM_TYPES})


def _deviation(suffix: str) -> str:
    """Sample deviation, for any size.

    The squares are taken around the mean rounded to a cent, exactly, as no
    term is larger than the sum of squares; what the rounding adds is small
    and is subtracted last, so nothing cancels.
    """
    n, total, squares = f"n_{suffix}", f"sum_{suffix}", f"sq_{suffix}"
    centre = f"CAST({total} / {n} AS DECIMAL(18,2))"
    around = f"CAST({squares} - {centre} * {total} - {centre} * ({total} - {n} * {centre}) AS DOUBLE)"
    beside = f"(CAST({total} - {n} * {centre} AS DOUBLE) / {n})"
    return f"IF({n} > 1, sqrt(greatest({around} - {n} * {beside} * {beside}, 0D) / ({n} - 1)), NULL)"


def features_of_sums(sums: DataFrame) -> DataFrame:
    """The thirty per-partner values from a partner's sums."""
    spreads = []
    for suffix in SPREADS:
        spreads += [
            f"max_{suffix}", f"min_{suffix}",
            f"{_ratio(f'sum_{suffix}', f'n_{suffix}')} AS avg_{suffix}",
            f"{_deviation(suffix)} AS std_{suffix}",
        ]
    return sums.selectExpr(
        *PARTNER_KEY,
        "lines AS total_invoices",
        "closed AS closed_invoices_no",
        "closed_late AS closed_late_invoices_no",
        f"{_ratio('closed_late', 'closed')} AS paid_late_percent",
        "sum_paid AS paid_total",
        "sum_late_paid AS paid_late_total",
        f"{_ratio('sum_late_paid', 'sum_paid')} AS paid_late_raport_percent",
        f"coalesce({_ratio('late_days', 'late_lines')}, 0D) AS avg_days_paid_late",
        "lines - closed AS unpaid_invoices_no",
        "late_unpaid AS late_unpaid_invoices_no",
        f"coalesce({_ratio('late_unpaid', 'lines - closed')}, 0D) AS late_unpaid_invoices_percent",
        "sum_unpaid AS unpaid_invoices_sum",
        "sum_late_unpaid AS unpaid_invoices_late_sum",
        f"{_ratio('sum_late_unpaid', 'sum_unpaid')} AS late_unpaid_invoices_sum_percent",
        *spreads,
    )


def partner_features(lined: DataFrame) -> DataFrame:
    """The thirty per-partner values of stored fact lines."""
    return features_of_sums(partner_sums(lined))


def with_partner_features(lined: DataFrame, partners: DataFrame) -> DataFrame:
    """Every fact line with the values of its partner.

    An inner equi-join: the lines of a dominant partner can be split by
    adaptive execution against its single row.
    """
    return lined.join(partners, PARTNER_KEY)


def feature_snapshot(facts: DataFrame, partners: DataFrame) -> DataFrame:
    """One row per tenant, organisation, partner and location.

    The values depend on the partner alone, so only the key columns of the
    facts need a distinct.
    """
    places = facts.select(
        "ad_client_id", "ad_org_id", "c_bpartner_id", "c_bpartner_location_id"
    ).distinct()
    return places.join(partners, PARTNER_KEY)
