"""Training and test sets by time, and balanced orderings by class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..params import Params
from ..sources.storage import measured
from .positions import positions

# The order of a tenant's rows wherever one is needed; it is total.
ROW_ORDER = ["src_invoice_id", "line_no"]
MOMENT = "dateinvoiced"


def row_order() -> list:
    return [F.col(c) for c in ROW_ORDER]


def backoff_days(start: int = 365) -> list[int]:
    """The window lengths tried: each half of the one before, down to a day."""
    days = []
    while start > 0:
        days.append(start)
        start //= 2
    return days


def _before_newest(days: int | str) -> str:
    return f"newest - make_dt_interval({days})"


def split_windows(facts: DataFrame, eligible: str = "true", start: int = 365) -> DataFrame:
    """Per tenant the newest date and the first window with eligible test rows.

    ``n_days`` is null for a tenant without any.
    """
    newest = facts.groupBy("ad_client_id").agg(
        F.max(MOMENT).alias("newest"),
        F.max(F.expr(f"IF({eligible}, {MOMENT}, NULL)")).alias("newest_eligible"),
    )
    cases = " ".join(f"WHEN newest_eligible > {_before_newest(n)} THEN {n}" for n in backoff_days(start))
    return measured(newest.withColumn("n_days", F.expr(f"CASE {cases} END")), "split_windows")


def time_split(facts: DataFrame, eligible: str = "true", start: int = 365) -> DataFrame:
    """Eligible rows with ``is_test``: 1 inside the newest window, else 0.

    Tenants without enough data drop out.
    """
    windows = split_windows(facts, eligible, start).where("n_days IS NOT NULL").drop("newest_eligible")
    marked = facts.where(eligible).join(windows, "ad_client_id")
    return marked.withColumn("is_test", F.expr(f"IF({MOMENT} > {_before_newest('n_days')}, 1, 0)")).drop("newest")


def window_sizes(facts: DataFrame, eligible: str = "true", start: int = 365) -> DataFrame:
    """How many test rows every window length would give."""
    windows = split_windows(facts, eligible, start)
    days = backoff_days(start)
    counts = facts.where(eligible).join(windows.select("ad_client_id", "newest"), "ad_client_id").groupBy(
        "ad_client_id"
    ).agg(*[F.expr(f"count_if({MOMENT} > {_before_newest(n)})").alias(f"d{n}") for n in days])
    pairs = ", ".join(f"{n}, d{n}" for n in days)
    listed = counts.selectExpr("ad_client_id", f"stack({len(days)}, {pairs}) AS (days, test_rows)")
    chosen = windows.select("ad_client_id", "n_days")
    return listed.join(chosen, "ad_client_id").selectExpr(
        "ad_client_id", "days", "test_rows", "IF(days <=> n_days, 1, 0) AS chosen"
    )


def yearly_split(facts: DataFrame, years: int = 4, eligible: str = "true") -> DataFrame:
    """Every row once per n in 1..years where it trains or tests.

    Test rows of n lie in the n-th year back, training rows before it.
    """
    newest = measured(facts.groupBy("ad_client_id").agg(F.max(MOMENT).alias("newest")), "newest")
    rows = facts.where(eligible).join(newest, "ad_client_id").selectExpr(
        "*", f"explode(sequence(1, {years})) AS n_years"
    )
    role = (
        f"CASE WHEN {MOMENT} <= {_before_newest('365 * n_years')} THEN 'train' "
        f"WHEN {MOMENT} <= {_before_newest('365 * (n_years - 1)')} THEN 'test' END"
    )
    return rows.withColumn("role", F.expr(role)).where("role IS NOT NULL").drop("newest")


def class_sizes(rows: DataFrame) -> DataFrame:
    sizes = rows.groupBy("ad_client_id").agg(
        F.count_if(F.col("paid") == 1).alias("n_paid"), F.count_if(F.col("paid") == 0).alias("n_unpaid")
    )
    return measured(sizes, "class_sizes")


def class_problem(sizes: DataFrame) -> DataFrame:
    """Why a tenant's classes cannot be interleaved; null when they can."""
    return sizes.withColumn(
        "problem",
        F.expr(
            "CASE WHEN n_paid = 0 OR n_unpaid = 0 THEN 'all lines are of one class' "
            "WHEN least(n_paid, n_unpaid) < 2 THEN 'a class has fewer than two lines' END"
        ),
    )


def class_interleave(rows: DataFrame, params: Params) -> DataFrame:
    """``position``: the rarer class spread evenly between rows of the other.

    With s = ceil(larger / (smaller - 1)) the rarer class takes every
    (s + 1)-th place, the other the s places after each. ``rows`` is read more
    than once.
    """
    sizes = class_problem(class_sizes(rows)).where("problem IS NULL").selectExpr(
        "ad_client_id",
        "IF(n_unpaid > n_paid, 1, 0) AS rare_class",
        "CAST(ceil(greatest(n_paid, n_unpaid) / (least(n_paid, n_unpaid) - 1)) AS BIGINT) AS step",
    )
    ranked = positions(rows, ["ad_client_id", "paid"], row_order(), "class_position", params.hot_group_rows)
    spread = (
        "IF(paid = rare_class, class_position * (step + 1), "
        "(class_position div step) * (step + 1) + 1 + class_position % step)"
    )
    return ranked.join(sizes, "ad_client_id").withColumn("position", F.expr(spread)).drop("rare_class", "step")
