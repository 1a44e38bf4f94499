"""Registered queries: requests, feature look-up, predictions, cash flow."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import features, forest, score
from ..schemas import REQUEST
from ..sources import derived, tables
from ..sources.storage import scratch_path, stored
from . import scoring, training
from .oracle_base import statement
from .output import comparable, sql_columns
from .session import Entities, cleaned_tables, fact_table, full_fact_table, profile_lines, shown_partners

P = derived.PARAMS
RUN = datetime(2001, 2, 1)
LIKELY = 0.75


def requests(entities: Entities) -> DataFrame:
    """Invoices with an open amount; some name a location nobody knows."""
    opened = entities["c_invoice"].where("totalopenamt > 0")
    return opened.selectExpr(
        "c_invoice_id AS row_id", "ad_client_id", "c_invoice_id", "ad_org_id", "dateinvoiced", "c_bpartner_id",
        "IF(c_invoice_id % 23 = 0, c_bpartner_location_id + 100, c_bpartner_location_id) AS c_bpartner_location_id",
        "paymentrule", "grandtotal", "duedate", "totalopenamt",
        "CASE paymentrule WHEN '1' THEN 'A' WHEN '2' THEN 'C' WHEN '3' THEN 'D' WHEN '4' THEN 'K' END AS tendertype",
    ).select(*REQUEST.fieldNames())


def _snapshot(spark: SparkSession, sf_dir: str, entities: Entities) -> DataFrame:
    lines = profile_lines(spark, sf_dir, entities=entities)
    return stored(features.feature_snapshot(lines, features.partner_features(lines)), "snapshot")


EVENT_INPUT = "array<struct<c_invoice_id:bigint,grandtotal:decimal(18,2)>>"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON event per invoice; some lack the tenant, the input or its rows."""
    invoices = derived.ledger_sources(spark, sf_dir)["c_invoice"]
    body = invoices.selectExpr(
        "c_invoice_id AS event_id",
        """to_json(struct(
             IF(c_invoice_id % 17 = 0, NULL, ad_client_id) AS ad_client_id,
             CASE WHEN c_invoice_id % 19 = 0 THEN NULL
                  WHEN c_invoice_id % 23 = 0 THEN slice(array(struct(c_invoice_id, grandtotal)), 1, 0)
                  ELSE array(struct(c_invoice_id, grandtotal)) END AS input)) AS body""",
    )
    parsed = body.withColumn("event", F.expr(f"from_json(body, 'ad_client_id bigint, input {EVENT_INPUT}')"))
    return parsed.selectExpr("event_id", "event.ad_client_id", "event.input")


def score_input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(score.request_errors(_events(spark, sf_dir)))


def score_input_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(score.request_rows(_events(spark, sf_dir)))


def score_partner_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = cleaned_tables(spark, sf_dir)
    found = score.partner_lookup(_snapshot(spark, sf_dir, entities), requests(entities))
    return comparable(found.select(*score.PLACE_KEY, "total_invoices", "paid_total", "avg_paid"))


def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = cleaned_tables(spark, sf_dir)
    joined = score.join_features(requests(entities), _snapshot(spark, sf_dir, entities))
    return comparable(joined.select("row_id", *score.PLACE_KEY, "paidamt", "total_invoices", "unpaid_invoices_sum"))


def score_join_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = cleaned_tables(spark, sf_dir)
    return comparable(score.join_violations(requests(entities), _snapshot(spark, sf_dir, entities)))


REQUEST_FEATURES = (
    "row_id:i dayslate:i late:i paid:i unpaid_sum:m paid_late_sum:m closed_late_invoice:i "
    "days_late_closed_invoices_late:i invoice_late_unpaid:i unpaid_late_sum:m late_unpaid_invoices_sum_percent:r"
)


def score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = cleaned_tables(spark, sf_dir)
    rows = scoring.prepared_requests(requests(entities), _snapshot(spark, sf_dir, entities))
    return comparable(rows.select(*[item.rsplit(":", 1)[0] for item in REQUEST_FEATURES.split()]))


def _plain_answer(spark: SparkSession, sf_dir: str, unpaid_days: int | None) -> DataFrame:
    """Requests answered from the partner's history instead of a model."""
    entities = cleaned_tables(spark, sf_dir)
    asked = requests(entities)
    rows = score.join_features(asked, _snapshot(spark, sf_dir, entities))
    guesses = rows.selectExpr(
        "row_id", f"IF(closed_invoices_no / total_invoices >= {LIKELY}D, 1, 0) AS prediction", "avg_days_paid_late AS days"
    )
    guesses = stored(guesses, "guesses")
    return score.postprocess(asked, guesses, guesses, unpaid_days)


def score_postprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = _plain_answer(spark, sf_dir, 0)
    return comparable(answer.select("row_id", "totalopenamt", "paid_prediction", "daystosettle_prediction"))


def score_postprocess_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = score.predicted_unpaid(_plain_answer(spark, sf_dir, None))
    return comparable(answer.select("row_id", "paid_prediction", "daystosettle_prediction"))


def cashflow_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(score.cash_flow(_plain_answer(spark, sf_dir, 0)))


ANSWER = "row_id bigint, totalopenamt decimal(18,2), paid_prediction int, daystosettle_prediction double"


def score_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers written as JSON records and read back."""
    path = scratch_path(spark, "answers")
    tables.write_records(_plain_answer(spark, sf_dir, 0), path)
    return comparable(spark.read.schema(ANSWER).json(path))


UNTRAINED = 2


def score_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants whose requests are refused, with the reasons; one tenant has no classifier."""
    entities = cleaned_tables(spark, sf_dir)
    known = derived.ledger_sources(spark, sf_dir)["ad_client"].where(f"ad_client_id NOT IN (0, {UNTRAINED})").selectExpr(
        "'classification' AS model_type", "ad_client_id"
    )
    return comparable(scoring.refusals(requests(entities), _snapshot(spark, sf_dir, entities), known))


def profile_backjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact lines joined back to their distinct feature rows."""
    table = fact_table(spark, sf_dir).where("c_bpartner_id IS NOT NULL")
    key = ["ad_client_id", "c_invoice_id", "ad_org_id", "c_bpartner_id", "c_bpartner_location_id"]
    shown = ["paid_late_percent", "avg_paid"]
    lines = comparable(table.select(*key, "dateinvoiced", "grandtotal"))
    # A partner's values are the same on all its rows, so they need no part in the distinct.
    profiles = comparable(table.selectExpr(*key, "dateinvoiced AS dateinvoiced_y", "paid").distinct())
    profiles = features.with_partner_features(profiles, shown_partners(table, shown))
    return lines.join(profiles, key, "left").select(*lines.columns, "dateinvoiced_y", *shown, "paid")


def score_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train both models of every tenant, then answer all requests with them."""
    entities = cleaned_tables(spark, sf_dir)
    table = full_fact_table(spark, sf_dir, entities=entities)
    root = scratch_path(spark, "models")
    training.run(table, root, forest.Grid(), P, RUN)
    snapshot = stored(features.feature_snapshot(table, features.partner_features(table)), "snapshot")
    return scoring.score_requests(requests(entities), snapshot, root, partly=True)


QUERIES = {
    "score_input_checks": score_input_checks,
    "score_input_rows": score_input_rows,
    "score_partner_lookup": score_partner_lookup,
    "score_join": score_join,
    "score_join_violations": score_join_violations,
    "score_features": score_features,
    "score_postprocess": score_postprocess,
    "score_postprocess_null": score_postprocess_null,
    "cashflow_forecast": cashflow_forecast,
    "score_json": score_json,
    "score_refusals": score_refusals,
    "profile_backjoin": profile_backjoin,
    "score": score_models,
}

# ---- oracles ---------------------------------------------------------------

_REQUESTS = """
request AS (
  SELECT c_invoice_id AS row_id, ad_client_id, c_invoice_id, ad_org_id, dateinvoiced, c_bpartner_id,
    CASE WHEN c_invoice_id % 23 = 0 THEN c_bpartner_location_id + 100 ELSE c_bpartner_location_id END AS c_bpartner_location_id,
    paymentrule, grandtotal, duedate, totalopenamt, CAST(grandtotal - totalopenamt AS DECIMAL(18,2)) AS paidamt
  FROM inv WHERE totalopenamt > 0),
snapshot AS (
  SELECT * FROM (SELECT DISTINCT ad_client_id, ad_org_id, c_bpartner_id, c_bpartner_location_id FROM facts)
  JOIN partner USING (ad_client_id, c_bpartner_id)),
joined AS (
  SELECT * FROM request JOIN snapshot USING (ad_client_id, ad_org_id, c_bpartner_id, c_bpartner_location_id))"""

_DERIVED = """
dated AS (
  SELECT *, greatest(CAST(floor((epoch(dateinvoiced) - epoch(duedate)) / 86400) AS BIGINT), 0) AS dayslate,
    CASE WHEN grandtotal - paidamt <= 0.01 THEN 1 ELSE 0 END AS paid FROM joined),
derived AS (
  SELECT *, CASE WHEN dayslate > 0 THEN 1 ELSE 0 END AS late FROM dated)"""

_ANSWERS = """
answer AS (
  SELECT r.*, CASE WHEN j.row_id IS NOT NULL THEN
      CASE WHEN CAST(j.closed_invoices_no AS DOUBLE) / j.total_invoices >= 0.75 THEN 1 ELSE 0 END END AS paid_prediction,
    j.avg_days_paid_late AS days
  FROM request r LEFT JOIN joined j USING (row_id))"""

_ANSWERED = (
    "SELECT row_id, round(CAST(totalopenamt AS DOUBLE), 2) AS totalopenamt, CAST(paid_prediction AS BIGINT) AS paid_prediction, "
    "CASE WHEN paid_prediction = 0 THEN 0 ELSE round_even(days, 0) END AS daystosettle_prediction FROM answer"
)

ORACLE = {
    "score_json": statement(_ANSWERED, _REQUESTS, _ANSWERS),
    "score_refusals": statement(
        "SELECT ad_client_id, string_agg(reason, '; ' ORDER BY reason) AS reason FROM ("
        "SELECT ad_client_id, count(*) || ' rows do not meet exactly one feature row' AS reason FROM request "
        "WHERE row_id NOT IN (SELECT row_id FROM joined) GROUP BY 1 "
        f"UNION ALL SELECT DISTINCT ad_client_id, 'no classifier has been trained' FROM request WHERE ad_client_id = {UNTRAINED}) GROUP BY 1",
        _REQUESTS,
    ),
    "score_input_checks": statement(
        "SELECT c_invoice_id AS event_id, CASE WHEN c_invoice_id % 17 = 0 THEN 'tenant' WHEN c_invoice_id % 19 = 0 THEN 'input' "
        "ELSE 'empty' END AS problem, CAST(400 AS BIGINT) AS status, "
        "CASE WHEN c_invoice_id % 17 <> 0 AND c_invoice_id % 19 <> 0 THEN 'Input is mandatory in JSON body' "
        "ELSE 'ad_client_id is mandatory in JSON body' END AS message "
        "FROM c_invoice WHERE c_invoice_id % 17 = 0 OR c_invoice_id % 19 = 0 OR c_invoice_id % 23 = 0"
    ),
    "score_input_rows": statement(
        "SELECT c_invoice_id AS event_id, ad_client_id, c_invoice_id, round(CAST(grandtotal AS DOUBLE), 2) AS grandtotal "
        "FROM c_invoice WHERE c_invoice_id % 17 <> 0 AND c_invoice_id % 19 <> 0 AND c_invoice_id % 23 <> 0"
    ),
    "score_partner_lookup": statement(
        "SELECT "
        + sql_columns(
            "ad_client_id:i ad_org_id:i c_bpartner_id:i c_bpartner_location_id:i total_invoices:i paid_total:m avg_paid:r"
        )
        + " FROM snapshot s WHERE EXISTS (SELECT 1 FROM request r "
        "WHERE r.ad_client_id = s.ad_client_id AND r.c_bpartner_id = s.c_bpartner_id)",
        _REQUESTS,
    ),
    "score_join": statement(
        "SELECT "
        + sql_columns(
            "row_id:i ad_client_id:i ad_org_id:i c_bpartner_id:i c_bpartner_location_id:i paidamt:m total_invoices:i "
            "unpaid_invoices_sum:m"
        )
        + " FROM joined",
        _REQUESTS,
    ),
    "score_join_violations": statement(
        "SELECT row_id, ad_client_id, CAST(0 AS BIGINT) AS matches, 'missing' AS violation FROM request "
        "WHERE row_id NOT IN (SELECT row_id FROM joined)",
        _REQUESTS,
    ),
    "score_features": statement(
        "SELECT row_id, dayslate, CAST(late AS BIGINT) AS late, CAST(paid AS BIGINT) AS paid, "
        "round(CAST(grandtotal - paidamt AS DOUBLE), 2) AS unpaid_sum, round(CAST(paidamt * late AS DOUBLE), 2) AS paid_late_sum, "
        "CAST(late * paid AS BIGINT) AS closed_late_invoice, CAST(late * paid * dayslate AS BIGINT) AS days_late_closed_invoices_late, "
        "CAST(late * (1 - paid) AS BIGINT) AS invoice_late_unpaid, "
        "round(CAST((grandtotal - paidamt) * late AS DOUBLE), 2) AS unpaid_late_sum, "
        "round(late_unpaid_invoices_sum_percent, 6) AS late_unpaid_invoices_sum_percent FROM derived",
        _REQUESTS, _DERIVED,
    ),
    "score_postprocess": statement(
        _ANSWERED, _REQUESTS, _ANSWERS,
    ),
    "score_postprocess_null": statement(
        "SELECT row_id, CAST(0 AS BIGINT) AS paid_prediction, CAST(NULL AS DOUBLE) AS daystosettle_prediction "
        "FROM answer WHERE paid_prediction = 0",
        _REQUESTS, _ANSWERS,
    ),
    "cashflow_forecast": statement(
        "SELECT ad_client_id, CAST(date_trunc('month', dateinvoiced + INTERVAL 1 DAY * CAST(round_even(days, 0) AS INT)) AS TIMESTAMP) AS period, "
        "count(*) AS invoices, round(CAST(sum(totalopenamt) AS DOUBLE), 2) AS expected_amount "
        "FROM answer WHERE paid_prediction = 1 GROUP BY 1, 2",
        _REQUESTS, _ANSWERS,
    ),
    "profile_backjoin": statement(
        "SELECT "
        + sql_columns(
            "ad_client_id:i c_invoice_id:x ad_org_id:i c_bpartner_id:i c_bpartner_location_id:i dateinvoiced:t "
            "grandtotal:m dateinvoiced_y:t paid_late_percent:r avg_paid:r paid:i"
        )
        + " FROM (SELECT *, dateinvoiced AS dateinvoiced_y FROM full_facts)"
    ),
}
