"""Table schemas: the projected source columns, the cleaned tables, the facts,
the statistics tables and the scoring request."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "decimal(18,2)": MONEY,
    "double": T.DoubleType(),
}


def _table(columns: str) -> T.StructType:
    """One column a line: name, type and, where it must have a value, NOT NULL."""
    parts = [line.split() for line in columns.strip().splitlines()]
    return T.StructType([T.StructField(name, _TYPES[kind], not rule) for name, kind, *rule in parts])


# The columns that are read of each source table, in the order of the tables (fixed values).
INVOICE = _table("""
    c_invoice_id bigint NOT NULL
    ad_client_id bigint NOT NULL
    ad_org_id bigint NOT NULL
    dateinvoiced timestamp NOT NULL
    c_bpartner_id bigint NOT NULL
    c_bpartner_location_id bigint NOT NULL
    c_currency_id bigint NOT NULL
    paymentrule string NOT NULL
    c_paymentterm_id bigint NOT NULL
    grandtotal decimal(18,2) NOT NULL
    c_payment_id bigint
    c_cashline_id bigint
    duedate timestamp
    totalopenamt decimal(18,2) NOT NULL
    paidamt decimal(18,2) NOT NULL
    issotrx string NOT NULL
    docstatus string NOT NULL
    isreturntrx string NOT NULL
    created timestamp NOT NULL
""")

PAYMENT = _table("""
    c_payment_id bigint NOT NULL
    ad_client_id bigint NOT NULL
    ad_org_id bigint NOT NULL
    datetrx timestamp NOT NULL
    c_doctype_id bigint NOT NULL
    c_bpartner_id bigint
    c_invoice_id bigint
    tendertype string NOT NULL
    c_currency_id bigint NOT NULL
    payamt decimal(18,2) NOT NULL
    isallocated string NOT NULL
    duedate timestamp
    allocatedamt decimal(18,2) NOT NULL
    isreceipt string NOT NULL
    docstatus string NOT NULL
    created timestamp NOT NULL
""")

ALLOCATION = _table("""
    c_allocationline_id bigint NOT NULL
    ad_client_id bigint NOT NULL
    ad_org_id bigint NOT NULL
    c_invoice_id bigint
    c_bpartner_id bigint
    c_payment_id bigint
    c_cashline_id bigint
    amount decimal(18,2) NOT NULL
    created timestamp NOT NULL
""")

TERM = _table("""
    c_paymentterm_id bigint NOT NULL
    ad_client_id bigint NOT NULL
    netdays bigint NOT NULL
    created timestamp NOT NULL
""")

TENANT = _table("ad_client_id bigint NOT NULL")

SOURCES = {
    "c_invoice": INVOICE,
    "c_payment": PAYMENT,
    "c_allocationline": ALLOCATION,
    "c_paymentterm": TERM,
    "ad_client": TENANT,
}

PRIMARY_KEY = {
    "c_invoice": "c_invoice_id",
    "c_payment": "c_payment_id",
    "c_allocationline": "c_allocationline_id",
    "c_paymentterm": "c_paymentterm_id",
    "ad_client": "ad_client_id",
}

# What identifies a row of each entity; terms are shared, so their ids repeat between tenants.
KEY = {entity: [own] for entity, own in PRIMARY_KEY.items()} | {"c_paymentterm": ["ad_client_id", "c_paymentterm_id"]}

# Columns a cleaned table may not hold null in (fixed values).
CLEAN_REQUIRED = {
    "c_invoice": [
        "c_invoice_id", "ad_client_id", "ad_org_id", "dateinvoiced", "c_bpartner_id",
        "c_bpartner_location_id", "c_currency_id", "paymentrule", "c_paymentterm_id",
        "grandtotal", "totalopenamt", "paidamt",
    ],
    "c_payment": [
        "c_payment_id", "ad_client_id", "ad_org_id", "datetrx", "c_doctype_id",
        "tendertype", "payamt", "isallocated", "allocatedamt",
    ],
    "c_allocationline": ["c_allocationline_id", "ad_client_id", "ad_org_id", "amount"],
    "c_paymentterm": ["c_paymentterm_id", "ad_client_id", "netdays"],
}

FACT_REQUIRED = [
    "ad_client_id", "ad_org_id", "dateinvoiced", "c_bpartner_id", "c_invoice_id",
    "c_bpartner_location_id", "paymentrule", "grandtotal", "totalopenamt", "paidamt",
]

FACT_FLAGS = ["late", "paid", "closed_late_invoice"]

# Values a cleaned table takes on when the writer supplies none (fixed values).
DEFAULTS = {
    "c_invoice": {"paymentrule": "P", "grandtotal": 0, "totalopenamt": 0, "paidamt": 0},
    "c_payment": {"tendertype": "K", "payamt": 0, "isallocated": "N", "allocatedamt": 0},
    "c_allocationline": {"amount": 0},
    "c_paymentterm": {"netdays": 0},
    "facts": {"grandtotal": 0, "totalopenamt": 0, "paidamt": 0, "allocatedamt": 0},
}

# A scoring request, and the statistics of a cleaning run (fixed values).
REQUEST = _table("""
    row_id bigint
    ad_client_id bigint
    c_invoice_id bigint
    ad_org_id bigint
    dateinvoiced timestamp
    c_bpartner_id bigint
    c_bpartner_location_id bigint
    paymentrule string
    grandtotal decimal(18,2)
    duedate timestamp
    totalopenamt decimal(18,2)
    tendertype string
""")

CLEANING_STATS = _table("""
    ad_client_id bigint
    date_run timestamp
    runtime_in_seconds double
    no_entries_invoices bigint
    no_entries_alloc bigint
    no_entries_payments bigint
    no_entries_terms bigint
    no_clean_entries_invoices bigint
    no_clean_entries_alloc bigint
    no_clean_entries_payments bigint
    no_clean_entries_terms bigint
    invoices_remaining_percent double
    alloc_remaining_percent double
    payments_remaining_percent double
    terms_remaining_percent double
    avg_remaining_percent double
    no_total_aggregated_rows bigint
""")

# The line columns that the fact table starts with, in its column order (fixed values).
FACT_LINE = [
    "ad_client_id", "ad_org_id", "dateinvoiced", "c_bpartner_id", "c_invoice_id",
    "c_bpartner_location_id", "paymentrule", "grandtotal", "duedate", "totalopenamt",
    "paidamt", "datetrx", "tendertype", "allocatedamt", "c_allocationline_id",
    "dayslate", "daystosettle", "late", "paid",
]
