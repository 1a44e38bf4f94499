"""A receivables ledger derived from the order and customer tables.

It has the shape and the dirt of an ERP export and serves as input for tests,
benchmarks and the registered queries. ``story`` (order key modulo 12) decides
how an invoice is settled: 0 paid once, 1 in advance, 2 in part, 3 overpaid,
4 open, 5 two payments plus allocations, 6 allocated in full, 7 cash,
8 allocated in part, 9 several allocations in full, 10 in part, 11 no data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..params import Params
from . import tables
from .storage import stored

PARAMS = Params(as_of=datetime(2001, 2, 1))

BASE = [
    "o_orderkey AS id",
    "o_custkey AS partner",
    "CAST(c_nationkey % 4 AS BIGINT) AS ad_client_id",
    "CAST(c_nationkey AS BIGINT) AS ad_org_id",
    "CAST(o_orderdate AS TIMESTAMP_NTZ) AS day",
    "CAST(o_totalprice AS DECIMAL(18,2)) AS total",
    "o_orderkey % 12 AS story",
    "substr(o_orderpriority, 1, 1) AS priority",
]

INVOICES = [
    "id AS c_invoice_id",
    "ad_client_id",
    "ad_org_id",
    "day AS dateinvoiced",
    "partner AS c_bpartner_id",
    "partner % 7 AS c_bpartner_location_id",
    "IF(id % 29 = 0, 100, 346) AS c_currency_id",
    "priority AS paymentrule",
    "1 + id % 5 AS c_paymentterm_id",
    "total AS grandtotal",
    "IF(story IN (0, 1), 1000000 + id * 10, NULL) AS c_payment_id",
    "IF(story = 7, 9000000 + id, NULL) AS c_cashline_id",
    """CASE WHEN id % 31 = 0 THEN NULL
            WHEN id % 37 = 0 THEN day - INTERVAL 5 DAYS
            ELSE day + make_dt_interval(CAST(15 * (1 + id % 5) AS INT)) END AS duedate""",
    """CASE story WHEN 4 THEN total WHEN 2 THEN total * 0.6 WHEN 8 THEN total * 0.5
            WHEN 10 THEN total * 0.4 WHEN 11 THEN total * 0.4 ELSE 0 END AS totalopenamt""",
    """CASE story WHEN 4 THEN 0 WHEN 2 THEN total * 0.4 WHEN 3 THEN total * 1.1 WHEN 8 THEN total * 0.5
            WHEN 10 THEN total * 0.6 WHEN 11 THEN total * 0.6 ELSE total END AS paidamt""",
    "IF(id % 41 = 0, 'N', 'Y') AS issotrx",
    "IF(id % 43 = 0, 'DR', 'CO') AS docstatus",
    "IF(id % 47 = 0, 'Y', 'N') AS isreturntrx",
    "day + INTERVAL 1 DAY AS created",
]

PAYMENT_COPIES = "explode(IF(story IN (5, 9, 10), array(0L, 1L), array(0L))) AS s"

PAYMENTS = [
    "1000000 + id * 10 + s AS c_payment_id",
    "ad_client_id",
    "ad_org_id",
    """CASE WHEN id % 67 = 0 THEN NULL WHEN story = 1 OR (story IN (2, 5, 6, 8, 9, 10) AND id % 5 = 0) THEN day - INTERVAL 3 DAYS
            ELSE day + make_dt_interval(CAST(5 + (id * 7 + s * 13) % 90 AS INT)) END AS datetrx""",
    "500 + id % 3 AS c_doctype_id",
    "partner AS c_bpartner_id",
    "IF(story IN (0, 1, 2, 3, 5), id, NULL) AS c_invoice_id",
    "CASE id % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'A' ELSE 'C' END AS tendertype",
    "346 AS c_currency_id",
    "total AS payamt",
    "'Y' AS isallocated",
    "day + INTERVAL 30 DAYS AS duedate",
    """CASE WHEN story = 5 AND s = 0 THEN total * 0.7 WHEN story = 5 THEN total * 0.3
            WHEN story = 2 THEN total * 0.4 WHEN story = 3 THEN total * 1.1
            ELSE total END AS allocatedamt""",
    "IF(id % 53 = 0, 'N', 'Y') AS isreceipt",
    "IF(id % 59 = 0, 'DR', 'CO') AS docstatus",
    "day + INTERVAL 2 DAYS AS created",
]

ALLOCATION_COPIES = """explode(CASE WHEN story IN (5, 9, 10) THEN array(0L, 1L, 2L)
    WHEN story IN (6, 7, 8) OR id % 24 = 23 THEN array(0L) END) AS s"""

ALLOCATIONS = [
    "5000000 + id * 10 + s AS c_allocationline_id",
    "ad_client_id",
    "ad_org_id",
    "id AS c_invoice_id",
    "partner AS c_bpartner_id",
    "IF(story IN (7, 11) OR s = 2, NULL, 1000000 + id * 10 + s) AS c_payment_id",
    "IF(story = 7 OR s = 2, 9000000 + id, NULL) AS c_cashline_id",
    """CASE WHEN id % 61 = 0 THEN -total WHEN story IN (6, 7) THEN total WHEN story = 8 THEN total * 0.5
            WHEN story IN (5, 9) AND s = 0 THEN total * 0.5 WHEN story IN (5, 9) AND s = 1 THEN total * 0.3
            WHEN story IN (5, 9, 10) THEN total * 0.2 ELSE total * 0.3 END AS amount""",
    "day + INTERVAL 3 DAYS AS created",
]

TERMS = [
    "c_paymentterm_id",
    "ad_client_id",
    "15 * c_paymentterm_id AS netdays",
    "TIMESTAMP_NTZ '1994-12-31 00:00:00' AS created",
]


def ledger_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five source tables. Orders meet their customers once, not once a table."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    base = stored(orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(*BASE), "orders")
    tenants = customers.selectExpr("CAST(c_nationkey % 4 AS BIGINT) AS ad_client_id").distinct()
    with_payments = base.where("story NOT IN (4, 7, 11)").selectExpr("*", PAYMENT_COPIES)
    with_allocations = base.selectExpr("*", ALLOCATION_COPIES)
    built = {
        "c_invoice": base.selectExpr(*INVOICES),
        "c_payment": with_payments.selectExpr(*PAYMENTS),
        "c_allocationline": with_allocations.selectExpr(*ALLOCATIONS),
        "c_paymentterm": tenants.selectExpr("*", "explode(sequence(1L, 5L)) AS c_paymentterm_id").selectExpr(*TERMS),
        "ad_client": tenants,
    }
    return {name: tables.project(df, name) for name, df in built.items()}
