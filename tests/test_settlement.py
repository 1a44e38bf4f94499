"""Settlement against golden counts and hand-worked invoices."""

from dataclasses import replace
from datetime import datetime

import making
import pytest
from pyspark.sql import functions as F

from duecast.operators import clean, features, ledger, partners, settle
from duecast.params import Params
from duecast.sources import derived

# Lines and facts per branch at scale 0.001.
GOLDEN = {
    "fully_paid": (75, 75), "partially_paid": (138, 138), "unpaid_balance": (63, 63),
    "partially_paid_2": (142, 116), "cash_paid": (79, 79), "p1": (280, 232), "unpaid_invoices": (81, 81),
    "cash_paid4": (142, 140), "fp2": (60, 60), "unpaid_balance2": (65, 65), "p2": (54, 54),
    "cash_paid2": (79, 79), "cash_paid3": (73, 73), "p3": (104, 104), "p4": (106, 106),
}


@pytest.fixture(scope="module")
def cleaned(spark, small):
    return {k: v.cache() for k, v in clean.clean_all(derived.ledger_sources(spark, small)).items()}


def _by_branch(df):
    return {r["branch"]: r["n"] for r in df.groupBy("branch").agg(F.count("*").alias("n")).collect()}


def _settled(cleaned, params):
    rows = ledger.classified(cleaned, params)
    return settle.ledger_lines(rows, cleaned["c_allocationline"], cleaned["c_payment"], params)


def _first_stage(cleaned):
    due = settle.due_invoices(cleaned["c_invoice"], cleaned["c_paymentterm"], derived.PARAMS)
    linked = settle.with_links(due, cleaned["c_payment"], cleaned["c_allocationline"])
    return due, settle.stage1(linked, cleaned["c_payment"])


def test_cleaned_counts(cleaned):
    counts = [cleaned[t].count() for t in ("c_invoice", "c_payment", "c_allocationline", "c_paymentterm")]
    assert counts == [1031, 1042, 1096, 15]


def test_stage_counts(cleaned):
    _, rows = _first_stage(cleaned)
    assert _by_branch(rows) == {
        "fully_paid": 156, "partially_paid": 158, "partially_paid_2": 148, "unpaid_invoices": 85, "residual": 494,
    }
    assert _by_branch(settle.stage2(settle.residual(rows), cleaned["c_allocationline"])) == {
        "cash_paid": 81, "fp2": 82, "p2": 67, "cash_paid2": 82, "p3": 164, "cash_paid3": 75, "p4": 150,
        "no_allocation": 68, "unsupported": 39,
    }


def test_line_and_fact_counts(cleaned):
    assert _by_branch(_settled(cleaned, derived.PARAMS)) == {b: n for b, (n, _) in GOLDEN.items()}
    facts = ledger.build_facts(cleaned, derived.PARAMS)
    assert _by_branch(facts) == {b: n for b, (_, n) in GOLDEN.items()}
    assert str(facts.agg(F.sum("grandtotal")).first()[0]) == "193265286.62"


def test_every_row_gets_one_branch(cleaned):
    due, rows = _first_stage(cleaned)
    assert rows.where("branch IS NULL").count() == 0
    assert rows.select("ad_client_id", "c_invoice_id").distinct().count() == due.count()


def test_line_ids_are_unique(cleaned):
    facts = ledger.build_facts(cleaned, derived.PARAMS)
    assert facts.count() == facts.select("ad_client_id", "c_invoice_id").distinct().count()


def test_rows_do_not_depend_on_order_or_partitions(spark, cleaned):
    shuffled = {k: v.repartition(7).orderBy(F.rand(3)) for k, v in cleaned.items()}
    first, second = (ledger.build_facts(c, derived.PARAMS) for c in (cleaned, shuffled))
    assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0


def test_crowded_invoices_are_numbered_the_same(cleaned):
    """Splitting groups that are too large for a task changes nothing."""
    tight = replace(derived.PARAMS, hot_group_rows=3)
    assert ledger.crowded_invoices(ledger.classified(cleaned, tight), tight).count() > 100
    first, second = (ledger.build_facts(cleaned, p) for p in (derived.PARAMS, tight))
    assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0


def test_features_by_window_and_by_aggregation_agree(cleaned):
    from pyspark.sql import Window

    lines = features.line_features(ledger.build_facts(cleaned, derived.PARAMS))
    joined = features.with_partner_features(lines, features.partner_features(lines))
    w = Window.partitionBy(*features.PARTNER_KEY)
    again = joined.select(
        "total_invoices", F.count("*").over(w).alias("n"),
        "paid_total", F.coalesce(F.sum("allocatedamt").over(w), F.lit(0)).alias("s"),
        "max_late_paid", F.max("paid_late_sum").over(w).alias("m"),
        "std_unpaid", F.stddev_samp(F.col("unpaid_sum").cast("double")).over(w).alias("d"),
    )
    wrong = again.where(
        "total_invoices <> n OR paid_total <> s OR NOT max_late_paid <=> m "
        "OR abs(coalesce(std_unpaid, 0) - coalesce(d, 0)) > 1e-4"
    )
    assert wrong.count() == 0


def _same_features(cleaned, params):
    lines = features.line_features(ledger.build_facts(cleaned, params))
    by_lines = {(r[0], r[1]): r for r in features.partner_features(lines).collect()}
    direct = {(r[0], r[1]): r for r in partners.build_partner_features(cleaned, params).collect()}
    assert by_lines == direct
    return direct


def test_features_without_pairs_equal_features_of_the_lines(spark, cleaned):
    assert len(_same_features(cleaned, derived.PARAMS)) == 111
    assert _same_features(clean.clean_all(making.hand_sources(spark)), Params())
    _same_features(cleaned, replace(derived.PARAMS, dedupe_installments=True))


def test_an_invoice_with_very_many_installments(spark):
    """Fifty thousand payments and as many allocations: 2.5 billion lines."""
    n = 50_000
    parts = making.sources(spark, [{"c_invoice_id": 1, "grandtotal": 100, "paidamt": 100}])
    pays, allocs = parts["c_payment"].schema, parts["c_allocationline"].schema
    created = "TIMESTAMP_NTZ '2020-01-11 00:00:00' AS created"
    parts["c_payment"] = spark.range(n).selectExpr(
        "id + 1 AS c_payment_id", "1L AS ad_client_id", "10L AS ad_org_id",
        "TIMESTAMP_NTZ '2020-02-01 00:00:00' + make_dt_interval(CAST(id % 20 AS INT)) AS datetrx",
        "500L AS c_doctype_id", "'K' AS tendertype", "346L AS c_currency_id", "CAST(1 AS DECIMAL(18,2)) AS payamt",
        "'Y' AS isallocated", "CAST(2 AS DECIMAL(18,2)) AS allocatedamt", "'Y' AS isreceipt", "'CO' AS docstatus",
        created, "7L AS c_bpartner_id", "1L AS c_invoice_id", "CAST(NULL AS TIMESTAMP_NTZ) AS duedate",
    ).select(*pays.fieldNames())
    parts["c_allocationline"] = spark.range(n).selectExpr(
        "id + 1 AS c_allocationline_id", "1L AS ad_client_id", "10L AS ad_org_id",
        "CAST(1 + id % 3 AS DECIMAL(18,2)) AS amount", created, "1L AS c_invoice_id", "7L AS c_bpartner_id",
        "id + 1 AS c_payment_id", "0L AS c_cashline_id",
    ).select(*allocs.fieldNames())
    got = partners.build_partner_features(clean.clean_all(parts), Params()).first()
    assert got["total_invoices"] == n * n + n
    # Ten of the twenty payment days lie after the due date (2020-02-10).
    assert got["closed_late_invoices_no"] == n * n // 2 + n // 2
    total = sum(1 + i % 3 for i in range(n)) * n + 2 * n
    assert got["paid_total"] == total
    squares = sum((1 + i % 3) ** 2 for i in range(n)) * n + 4 * n
    lines = n * n + n
    assert got["std_paid"] == pytest.approx(((squares - total**2 / lines) / (lines - 1)) ** 0.5, rel=1e-9)


# ---- hand rows -------------------------------------------------------------

# (branch, total, paid amount, allocated, days to settle, days late, paid)
EXPECTED = {
    1: [("fully_paid", 100, 100, 100, 22, 0, 1)],
    2: [],
    3: [("partially_paid", 40, 40, 40, 41, 10, 1), ("unpaid_balance", 60, 0, None, None, 356, 0)],
    4: [("partially_paid", 100, 100, 100, 22, 0, 1)],
    5: [("partially_paid_2", 70, 70, 70, 22, 0, 1), ("partially_paid_2", 30, 30, 30, 26, 0, 1),
        ("p1", 100, 100, 100, 22, 0, 1), ("p1", 100, 100, 100, 26, 0, 1)],
    6: [("unpaid_invoices", 100, 0, None, None, 356, 0)],
    7: [("cash_paid", 100, 100, 100, 0, 0, 1)],
    8: [("fp2", 100, 100, 100, 36, 5, 1)],
    9: [("p2", 100, 100, 100, 36, 5, 1)],
    10: [("unpaid_balance2", 50, 0, None, None, 356, 0), ("p2", 50, 50, 50, 36, 5, 1)],
    11: [("unpaid_balance2", 50, 0, None, None, 356, 0)],
    12: [("unpaid_balance2", 50, 0, None, None, 356, 0), ("p2", 50, 50, 50, None, 356, 1)],
    13: [("cash_paid2", 60, 100, 60, 0, 0, 1), ("p3", 40, 40, 40, 36, 5, 1)],
    14: [],
    15: [("cash_paid3", 30, 30, 30, 0, 0, 1), ("p4", 40, 40, 40, 36, 5, 1)],
    16: [],
    17: [],
    18: [("partially_paid_2", 70, 70, 70, 22, 0, 1), ("partially_paid_2", 30, 30, 30, 26, 0, 1),
         ("cash_paid4", 100, 100, 100, 0, 0, 1), ("cash_paid4", 100, 100, 100, 0, 0, 1)],
    19: [],
    20: [],
}


@pytest.fixture(scope="module")
def hand_facts(spark):
    cleaned = clean.clean_all(making.hand_sources(spark))
    return ledger.build_facts(cleaned, Params(as_of=datetime(2021, 1, 31))).collect()


@pytest.mark.parametrize("number", sorted(EXPECTED))
def test_hand_row(hand_facts, number):
    rows = sorted((r for r in hand_facts if r["src_invoice_id"] == number), key=lambda r: r["line_no"])

    def plain(value):
        return None if value is None else int(value)

    found = [
        (r["branch"], plain(r["grandtotal"]), plain(r["paidamt"]), plain(r["allocatedamt"]), r["daystosettle"],
         r["dayslate"], r["paid"])
        for r in rows
    ]
    assert found == EXPECTED[number]
    ids = [r["c_invoice_id"] for r in rows]
    assert ids == ([str(number)] if len(rows) == 1 else [f"{number}_{i}" for i in range(len(rows))])


def test_missing_due_date_is_filled_on_request(spark):
    cleaned = clean.clean_all(making.hand_sources(spark))
    rows = ledger.build_facts(cleaned, Params(fill_missing_duedate=True)).where("src_invoice_id = 19").collect()
    assert [(r["branch"], r["duedate"]) for r in rows] == [("unpaid_invoices", datetime(2020, 2, 9))]


def test_due_date_as_null_text_comes_from_the_term(spark):
    invoices = clean.clean_all(making.hand_sources(spark))["c_invoice"]
    terms = clean.clean_all(making.hand_sources(spark))["c_paymentterm"]
    text = invoices.withColumn("duedate", F.coalesce(F.col("duedate").cast("string"), F.lit("\\N")))
    due = {r["c_invoice_id"]: r["duedate"] for r in settle.due_invoices(text, terms, Params()).collect()}
    assert due[19] == datetime(2020, 2, 9) and due[1] == datetime(2020, 2, 10) and 20 not in due


def test_installments_counted_once_on_request(spark):
    cleaned = clean.clean_all(making.hand_sources(spark))
    rows = ledger.build_facts(cleaned, Params(dedupe_installments=True)).where("src_invoice_id IN (5, 18)")
    assert _by_branch(rows) == {"partially_paid_2": 4}


def test_tenant_without_allocations_gives_no_facts(spark):
    parts = making.sources(spark, [{"c_invoice_id": 1, "grandtotal": 5, "paidamt": 0}],
                           [{"c_payment_id": 1, "allocatedamt": 1, "datetrx": making.day("2020-02-01")}])
    assert ledger.build_facts(clean.clean_all(parts), Params()).count() == 0


def test_tenant_without_split_invoices_can_be_dropped(spark):
    invoices = [{"c_invoice_id": 1, "grandtotal": 5, "paidamt": 0}, {"c_invoice_id": 2, "grandtotal": 9, "paidamt": 9}]
    parts = making.sources(spark, invoices,
                           [{"c_payment_id": 1, "allocatedamt": 1, "datetrx": making.day("2020-02-01")}],
                           [{"c_allocationline_id": 1, "c_invoice_id": 2, "amount": 9, "c_cashline_id": 4}])
    cleaned = clean.clean_all(parts)
    assert ledger.build_facts(cleaned, Params()).count() == 2
    assert ledger.build_facts(cleaned, Params(require_split_invoices=True)).count() == 0


def test_lateness_does_not_depend_on_the_session_time_zone(spark):
    cleaned = clean.clean_all(making.hand_sources(spark))
    params = Params(as_of=datetime(2021, 1, 31))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        late = {r["c_invoice_id"]: r["dayslate"] for r in ledger.build_facts(cleaned, params).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert late["6"] == 356 and late["8"] == 5


def test_days_are_floored_on_the_wall_clock(spark):
    from duecast.functions.columns import floor_days

    rows = spark.sql(
        "SELECT TIMESTAMP_NTZ '2020-03-29 01:00:00' AS a, TIMESTAMP_NTZ '2020-03-29 03:00:00' AS b, "
        "TIMESTAMP_NTZ '2020-03-31 02:59:59' AS c"
    )
    got = rows.select(floor_days(F.col("a"), F.col("b")), floor_days(F.col("c"), F.col("b")), floor_days(F.col("b"), F.col("a")))
    assert tuple(got.first()) == (-1, 1, 0)


def test_invoices_of_undated_payments_stay(spark):
    """A payment without a date settles nothing, but its invoice is not lost."""
    sources = making.hand_sources(spark)
    undated = sources["c_payment"].withColumn("datetrx", F.lit(None).cast("timestamp_ntz"))
    tables = clean.clean_all({**sources, "c_payment": undated})
    lines = _settled(tables, Params()).collect()
    branches = {(r["c_invoice_id"], r["branch"]) for r in lines}
    # Paid in instalments by undated payments, allocated in cash; and open.
    assert {(18, "cash_paid"), (6, "unpaid_invoices")} <= branches
    assert all(r["tendertype"] == "K" for r in lines if r["c_invoice_id"] == 18)


def test_a_hot_invoice_is_dealt_over_tasks(spark, cleaned):
    """A third of all payments on one invoice: the join of the first stage is split by adaptive execution."""
    import re

    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16",
    }
    hot = "IF(c_payment_id % 3 = 0, 1, c_invoice_id)"
    # Many small files, as a task writes one piece of a partition.
    payments = cleaned["c_payment"].withColumn("c_invoice_id", F.expr(hot)).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(60))))
    payments = payments.drop("x").repartition(32)
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        linked = settle.with_links(cleaned["c_invoice"].withColumn("ad_client_id", F.lit(1)), payments.withColumn("ad_client_id", F.lit(1)), cleaned["c_allocationline"])
        rows = settle.stage1(linked, payments.withColumn("ad_client_id", F.lit(1)))
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert re.search(r"skew=true", plan)
