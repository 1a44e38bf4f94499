"""Feature lists and the preparation of model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.storage import measured
from .features import SPREADS

# The model inputs in their order (fixed values).
PARTNER_INPUTS = [
    "closed_late_invoices_no", "paid_late_percent", "paid_late_total", "paid_late_raport_percent",
    "avg_days_paid_late", "late_unpaid_invoices_no", "late_unpaid_invoices_percent",
    "unpaid_invoices_late_sum", "late_unpaid_invoices_sum_percent",
]
SPREAD_INPUTS = [f"{stat}_{suffix}" for suffix in SPREADS for stat in ("max", "min", "avg", "std")]
NUMERIC = [*PARTNER_INPUTS, *SPREAD_INPUTS, "late", "dayslate", "totalopenamt"]
CATEGORICAL = ["paymentrule", "tendertype"]
FEATURES = NUMERIC + CATEGORICAL

CLASS_TARGET = "paid"
DAYS_TARGET = "daystosettle"
MISSING = "Missing"


def roles(facts: DataFrame) -> DataFrame:
    """Each feature with its role and how many rows of a tenant have a value."""
    counts = facts.groupBy("ad_client_id").agg(*[F.count(c).alias(c) for c in FEATURES])
    pairs = ", ".join(
        f"'{c}', '{'numeric' if c in NUMERIC else 'categorical'}', {c}" for c in FEATURES
    )
    return counts.selectExpr("ad_client_id", f"stack({len(FEATURES)}, {pairs}) AS (feature, role, filled)")


def impute_constant(rows: DataFrame) -> DataFrame:
    """Numeric gaps as 0, categorical gaps as their own category."""
    changed = {c: F.expr(f"coalesce(CAST({c} AS DOUBLE), 0D)") for c in NUMERIC}
    changed |= {c: F.expr(f"coalesce({c}, '{MISSING}')") for c in CATEGORICAL}
    return rows.withColumns(changed)


def mean_impute(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Gaps filled with the mean of their group, each split with its own.

    A column without any value in the group stays null.
    """
    means = rows.groupBy(*by).agg(*[F.expr(f"avg(CAST({c} AS DOUBLE))").alias(f"mean_{c}") for c in columns])
    means = measured(means, "means")
    filled = {c: F.expr(f"coalesce(CAST({c} AS DOUBLE), mean_{c})") for c in columns}
    return rows.join(means, by).withColumns(filled).drop(*[f"mean_{c}" for c in columns])


def standard_scale(rows: DataFrame, fit_on: str, columns: list[str]) -> DataFrame:
    """Centred and divided by the population deviation of the fitted rows.

    A constant column is only centred.
    """
    spread = "IF(max({0}) = min({0}), 1D, stddev_pop(CAST({0} AS DOUBLE)))"
    fitted = rows.where(fit_on).groupBy("ad_client_id").agg(
        *[F.expr(f"avg(CAST({c} AS DOUBLE))").alias(f"mean_{c}") for c in columns],
        *[F.expr(spread.format(c)).alias(f"dev_{c}") for c in columns],
    )
    fitted = measured(fitted, "scales")
    scaled = {c: F.expr(f"(CAST({c} AS DOUBLE) - mean_{c}) / dev_{c}") for c in columns}
    return rows.join(fitted, "ad_client_id").withColumns(scaled).drop(
        *[f"{p}_{c}" for c in columns for p in ("mean", "dev")]
    )


MAX_CATEGORIES = 1000


def categories(rows: DataFrame) -> dict[str, list[str]]:
    """The values of the categorical features, sorted; single letters by schema.

    Refuses a column that turns out not to be a small code set, so what comes
    to the driver is bounded.
    """
    found = {}
    for column in CATEGORICAL:
        values = rows.select(column).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(values) > MAX_CATEGORIES:
            raise ValueError(f"{column} has more than {MAX_CATEGORIES} categories")
        found[column] = sorted(v[0] for v in values if v[0] is not None)
    return found


def one_hot_expressions(vocabulary: dict[str, list[str]]) -> dict[str, str]:
    """Name and 0/1 expression per category; an unknown value gives all zeros."""
    return {
        f"{column}={value}": f"CASE WHEN {column} = '{value}' THEN 1D ELSE 0D END"
        for column, values in vocabulary.items()
        for value in (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    }
