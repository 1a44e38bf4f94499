"""Settlement: every invoice split into paid, part-paid and open ledger lines.

Three stages, each one equi-join and one ordered CASE. The first matching
case wins and a comparison with null does not match.

Every invoice first gets the numbers of payments and allocations that name it,
counted on key columns alone, and is stored with them. They say which rows
join at all, so each join is an inner one between two stored tables, whose both sides adaptive
execution can split where a key is frequent, and rows without a partner need no
join. The classified first stage is stored as well: all lines are made of it. So a table of payments is
read for its keys, for the first stage and for looking up what allocations name, one of
allocations for its keys and for one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import is_true, plus_days
from ..params import Params
from ..sources.storage import stored
from ..sources.tables import NULL_TEXT

INVOICE_KEY = ["ad_client_id", "c_invoice_id"]
PAYMENT_KEY = ["ad_client_id", "c_payment_id"]

# Line kinds in ledger order (fixed values).
BRANCHES = [
    "fully_paid", "partially_paid", "unpaid_balance", "partially_paid_2", "cash_paid",
    "p1", "unpaid_invoices", "cash_paid4", "fp2", "unpaid_balance2", "p2", "cash_paid2",
    "cash_paid3", "p3", "p4",
]

LINE_TYPES = {
    "ad_client_id": "bigint",
    "ad_org_id": "bigint",
    "dateinvoiced": "timestamp_ntz",
    "c_bpartner_id": "bigint",
    "c_invoice_id": "bigint",
    "c_bpartner_location_id": "bigint",
    "c_currency_id": "bigint",
    "paymentrule": "string",
    "grandtotal": "decimal(18,2)",
    "c_payment_id": "bigint",
    "c_cashline_id": "bigint",
    "duedate": "timestamp_ntz",
    "totalopenamt": "decimal(18,2)",
    "paidamt": "decimal(18,2)",
    "c_payment_id_paym": "bigint",
    "datetrx": "timestamp_ntz",
    "c_doctype_id": "bigint",
    "tendertype": "string",
    "payamt": "decimal(18,2)",
    "isallocated": "string",
    "allocatedamt": "decimal(18,2)",
    "c_allocationline_id": "bigint",
    "branch": "string",
    "source_payment_id": "bigint",
}

PAYMENT_PART = [
    "c_payment_id_paym", "datetrx", "c_doctype_id", "tendertype", "payamt", "isallocated", "allocatedamt",
]
ALLOCATION_PART = {
    "c_allocationline_id": "bigint",
    "alloc_payment_id": "bigint",
    "alloc_cashline_id": "bigint",
    "amount": "decimal(18,2)",
}

BALANCE = "(grandtotal - paidamt)"
KEEPS_BALANCE = f"NOT coalesce({BALANCE} < 0, false)"
IN_ADVANCE = "coalesce(datetrx < dateinvoiced, false)"


def _capped(amount: str) -> str:
    """An amount reduced by what was paid above the invoice total."""
    return f"IF({BALANCE} < 0, {amount} + {BALANCE}, {amount})"


def _same(branches: list[str], value: str) -> dict[str, str]:
    return {b: value for b in branches}


def _lines(df: DataFrame, changes: dict[str, dict[str, str]]) -> DataFrame:
    """The ledger-line columns, with per-branch values where they change."""
    present = set(df.columns)
    picked = []
    for name, kind in LINE_TYPES.items():
        value = name if name in present else "NULL"
        if name in changes:
            cases = " ".join(f"WHEN '{branch}' THEN {new}" for branch, new in changes[name].items())
            value = f"CASE branch {cases} ELSE {value} END"
        picked.append(f"CAST({value} AS {kind}) AS {name}")
    return df.selectExpr(*picked)


def due_invoices(invoices: DataFrame, terms: DataFrame, params: Params) -> DataFrame:
    """Invoices with their term's net days, not due before they were issued.

    A due date given as the null text of the export is worked out from the
    term. A null due date drops the invoice unless the parameters ask for the
    same treatment. No size is assumed for the terms: Spark broadcasts them
    when their measured size allows and splits a frequent term otherwise.
    """
    net = terms.select("c_paymentterm_id", "ad_client_id", "netdays")
    joined = invoices.join(net, ["c_paymentterm_id", "ad_client_id"], "left").withColumn(
        "duedate_calculated", plus_days(F.col("dateinvoiced"), F.col("netdays"))
    )
    due = F.col("duedate")
    if isinstance(invoices.schema["duedate"].dataType, T.StringType):
        absent = is_true(due == NULL_TEXT)
        parsed = F.when(~absent, due).cast("timestamp_ntz")
        kept = joined.where(absent | (F.col("dateinvoiced") <= parsed))
        return kept.withColumn("duedate", F.when(absent, F.col("duedate_calculated")).otherwise(parsed))
    if params.fill_missing_duedate:
        joined = joined.withColumn("duedate", F.coalesce(due, F.col("duedate_calculated")))
    return joined.where(F.col("dateinvoiced") <= F.col("duedate"))


def linked_payments(payments: DataFrame) -> DataFrame:
    """Payments that name an invoice. Those that do not would all meet on key 0."""
    return payments.where("c_invoice_id <> 0").selectExpr(
        *INVOICE_KEY, "c_payment_id AS c_payment_id_paym", *[c for c in PAYMENT_PART if c != "c_payment_id_paym"]
    )


def allocated_amounts(allocations: DataFrame) -> DataFrame:
    return allocations.selectExpr(
        *INVOICE_KEY,
        "c_allocationline_id",
        "c_payment_id AS alloc_payment_id",
        "c_cashline_id AS alloc_cashline_id",
        "amount",
    )


def stage1_case() -> Column:
    return F.expr(
        """CASE WHEN paidamt = allocatedamt AND paidamt = grandtotal THEN 'fully_paid'
                WHEN paidamt = allocatedamt THEN 'partially_paid'
                WHEN datetrx IS NOT NULL THEN 'partially_paid_2'
                WHEN paidamt = 0 THEN 'unpaid_invoices'
                ELSE 'residual' END"""
    )


def _with_empty(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in columns.items()])


LINKS = ["n_payments", "n_allocations"]


def with_links(invoices: DataFrame, payments: DataFrame, allocations: DataFrame) -> DataFrame:
    """Invoices with the numbers of payments and allocations that name them, stored."""
    links = payments.where("c_invoice_id <> 0").selectExpr(*INVOICE_KEY, "1L AS n_payments", "0L AS n_allocations")
    links = links.unionByName(allocations.selectExpr(*INVOICE_KEY, "0L AS n_payments", "1L AS n_allocations"))
    counts = links.groupBy(*INVOICE_KEY).agg(*[F.sum(c).alias(c) for c in LINKS])
    joined = invoices.join(counts, INVOICE_KEY, "left")
    return stored(joined.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in LINKS}), "linked_invoices")


def stage1(linked: DataFrame, payments: DataFrame) -> DataFrame:
    """Every invoice of ``with_links`` with its payments, classified."""
    matched = linked.where("n_payments > 0").join(linked_payments(payments), INVOICE_KEY)
    lonely = _with_empty(linked.where("n_payments = 0"), {c: LINE_TYPES[c] for c in PAYMENT_PART})
    return matched.unionByName(lonely).withColumn("branch", stage1_case())


def stage2_case() -> Column:
    return F.expr(
        """CASE WHEN amount IS NULL THEN 'no_allocation'
                WHEN paidamt = amount AND paidamt = grandtotal
                     AND alloc_cashline_id <> 0 AND alloc_payment_id = 0 THEN 'cash_paid'
                WHEN paidamt = amount AND paidamt = grandtotal THEN 'fp2'
                WHEN paidamt = amount AND alloc_payment_id <> 0 THEN 'p2'
                WHEN paidamt = grandtotal AND alloc_cashline_id <> 0 THEN 'cash_paid2'
                WHEN paidamt = grandtotal THEN 'p3'
                WHEN alloc_payment_id = 0 AND alloc_cashline_id = 0 THEN 'unsupported'
                WHEN alloc_cashline_id <> 0 THEN 'cash_paid3'
                ELSE 'p4' END"""
    )


def _with_allocations(rows: DataFrame, allocations: DataFrame) -> DataFrame:
    matched = rows.where("n_allocations > 0").join(allocated_amounts(allocations), INVOICE_KEY)
    return matched.unionByName(_with_empty(rows.where("n_allocations = 0"), ALLOCATION_PART))


def residual(rows: DataFrame) -> DataFrame:
    """Rows of the first stage that no payment settles: without one, or with one that has no date."""
    return rows.where("branch = 'residual'")


def stage2(rows: DataFrame, allocations: DataFrame) -> DataFrame:
    """Residual rows with their allocations, classified."""
    return _with_allocations(rows, allocations).withColumn("branch", stage2_case())


def stage3_case() -> Column:
    return F.expr("IF(coalesce(alloc_cashline_id = 0, false), 'p1', 'cash_paid4')")


IN_INSTALLMENTS = "branch = 'partially_paid_2' AND grandtotal = paidamt"


def paid_in_installments(rows: DataFrame) -> DataFrame:
    return rows.where(IN_INSTALLMENTS)


def stage3(installments: DataFrame, allocations: DataFrame) -> DataFrame:
    """Invoices paid in instalments with their allocations, classified.

    Each payment meets each allocation of its invoice: that pairing is what
    the ledger is defined to hold.
    """
    return _with_allocations(installments, allocations).withColumn("branch", stage3_case())


# ---- lines -----------------------------------------------------------------


def payment_lines(rows: DataFrame, params: Params) -> DataFrame:
    """Lines of the classified invoices that payments alone give.

    One row may give two lines: a part payment leaves a balance, and an
    instalment whose invoice has no allocation also gives an empty cash line.
    """
    empty_cash = "false" if params.dedupe_installments else "grandtotal = paidamt AND n_allocations = 0"
    named = F.when(F.col("branch") != "unpaid_invoices", F.col("c_payment_id_paym"))
    lines = rows.withColumn("source_payment_id", named).withColumn(
        "branch",
        F.expr(
            f"""explode(CASE
                WHEN branch = 'partially_paid_2' AND {empty_cash} THEN array(branch, 'cash_paid4')
                WHEN branch = 'partially_paid_2' THEN array(branch)
                WHEN branch = 'unpaid_invoices' THEN array(branch)
                WHEN {IN_ADVANCE} THEN NULL
                WHEN branch = 'partially_paid' AND {KEEPS_BALANCE} THEN array(branch, 'unpaid_balance')
                WHEN branch IN ('fully_paid', 'partially_paid') THEN array(branch) END)"""
        ),
    )
    amounts = {
        "partially_paid": _capped("allocatedamt"),
        "partially_paid_2": "allocatedamt",
        "unpaid_balance": BALANCE,
        "cash_paid4": "NULL",
    }
    dropped = _same(["unpaid_balance", "cash_paid4"], "NULL")
    return _lines(
        lines,
        {
            "grandtotal": amounts,
            "totalopenamt": amounts,
            "paidamt": {**amounts, "unpaid_balance": "0"},
            "allocatedamt": {"partially_paid": _capped("allocatedamt"), **dropped},
            "payamt": {"partially_paid": _capped("allocatedamt"), **dropped},
            "datetrx": {"unpaid_balance": "NULL", "cash_paid4": "dateinvoiced"},
            "c_cashline_id": {"cash_paid4": "NULL"},
            **{c: dropped for c in ("tendertype", "c_doctype_id", "isallocated", "c_payment_id_paym")},
        },
    )


FROM_PAYMENT = ["fp2", "p2", "p3", "p4"]
CASH = ["cash_paid", "cash_paid2", "cash_paid3"]
PAIRS = ["p1", "cash_paid4"]


def allocation_lines(rows: DataFrame, allocations: DataFrame, payments: DataFrame, params: Params) -> DataFrame:
    """Lines of invoices known only through allocations, and the (payment, allocation) lines of
    those paid in instalments, from one join with the allocations.

    The rows that need no payment carry a key no payment has, a negative hash,
    so that they spread instead of meeting on one null key.
    """
    instalments = "false" if params.dedupe_installments else IN_INSTALLMENTS
    wanted = rows.where(f"n_allocations > 0 AND (branch = 'residual' OR {instalments})")
    rows = wanted.withColumnsRenamed({c: f"own_{c}" for c in PAYMENT_PART}).join(allocated_amounts(allocations), INVOICE_KEY)
    needs_payment = "branch IN ('fp2', 'p2', 'p3', 'p4')"
    spread = "-1 - pmod(xxhash64(own_c_payment_id_paym, c_allocationline_id), 4611686018427387904L)"
    rows = (
        rows.withColumn("branch", F.when(F.col("branch") == "residual", stage2_case()).otherwise(stage3_case()))
        .where("branch NOT IN ('no_allocation', 'unsupported')")
        .where(f"NOT ({needs_payment}) OR alloc_payment_id <> 0")
        .withColumn("lookup_id", F.expr(f"IF({needs_payment}, alloc_payment_id, {spread})"))
        .withColumn("source_payment_id", F.expr("IF(branch IN ('p1', 'cash_paid4'), own_c_payment_id_paym, NULL)"))
    )
    paid_by = payments.selectExpr(
        "ad_client_id", "c_payment_id AS lookup_id", "datetrx", "c_doctype_id", "tendertype", "isallocated"
    )
    found = rows.join(paid_by, ["ad_client_id", "lookup_id"], "left")
    lines = found.withColumn(
        "branch",
        F.expr(
            f"""explode(CASE
                WHEN branch IN ('cash_paid', 'cash_paid2', 'cash_paid3', 'p1', 'cash_paid4') THEN array(branch)
                WHEN branch = 'p2' AND NOT {IN_ADVANCE} AND {KEEPS_BALANCE} THEN array(branch, 'unpaid_balance2')
                WHEN branch = 'p2' AND NOT {IN_ADVANCE} THEN array(branch)
                WHEN branch = 'p2' AND {KEEPS_BALANCE} THEN array('unpaid_balance2')
                WHEN branch <> 'p2' AND datetrx IS NOT NULL AND NOT {IN_ADVANCE} THEN array(branch) END)"""
        ),
    )
    balance = {"unpaid_balance2": BALANCE}
    settled = {**_same(["p3", "p4", "cash_paid2", "cash_paid3", *PAIRS], "amount"), "p2": _capped("amount")}
    # The second cash kind keeps the paid amount of the whole invoice.
    paid = {b: v for b, v in settled.items() if b != "cash_paid2"}
    shown = {**_same(["fp2", "p3", "p4", *CASH, *PAIRS], "amount"), "p2": _capped("amount")}
    own = lambda c: {"p1": f"own_{c}"}
    return _lines(
        lines,
        {
            "grandtotal": {**settled, **balance},
            "totalopenamt": {**settled, **balance},
            "paidamt": {**paid, "unpaid_balance2": "0"},
            "allocatedamt": shown,
            "payamt": {**shown, **own("payamt")},
            "datetrx": {**_same([*CASH, "cash_paid4"], "dateinvoiced"), "unpaid_balance2": "NULL", **own("datetrx")},
            "c_cashline_id": _same([*CASH, "cash_paid4"], "alloc_cashline_id"),
            "c_payment_id_paym": {
                **_same(FROM_PAYMENT, "c_payment_id"), **_same(CASH, "own_c_payment_id_paym"), **own("c_payment_id_paym"),
            },
            "c_payment_id": _same(FROM_PAYMENT, "alloc_payment_id"),
            **{
                c: {"unpaid_balance2": "NULL", "cash_paid4": "NULL", **_same(CASH, f"own_{c}"), **own(c)}
                for c in ("c_doctype_id", "tendertype", "isallocated")
            },
        },
    )


ARM_BRANCHES = {
    "payments": {"fully_paid", "partially_paid", "unpaid_balance", "partially_paid_2", "cash_paid4", "unpaid_invoices"},
    "allocations": {
        "cash_paid", "fp2", "unpaid_balance2", "p2", "cash_paid2", "cash_paid3", "p3", "p4", "p1", "cash_paid4",
    },
}


def ledger_invoices(invoices: DataFrame, terms: DataFrame, params: Params) -> DataFrame:
    """The invoices that lines are made of.

    The currency is a property of the invoice, so it is filtered before any
    join. The term only serves to fill a due date; as it is unique, it is not
    joined where nothing is filled.
    """
    own = invoices.where(f"c_currency_id = {params.currency}")
    if params.fill_missing_duedate or isinstance(own.schema["duedate"].dataType, T.StringType):
        due = due_invoices(own, terms, params)
    else:
        due = own.where("dateinvoiced <= duedate")
    return due.drop("c_paymentterm_id", "netdays", "duedate_calculated", "created")


def classified(
    invoices: DataFrame, allocations: DataFrame, payments: DataFrame, terms: DataFrame, params: Params
) -> DataFrame:
    """The first stage of all invoices in the run's currency, stored: what lines are made of."""
    linked = with_links(ledger_invoices(invoices, terms, params), payments, allocations)
    return stored(stage1(linked, payments), "classified_invoices")


def ledger_lines(
    rows: DataFrame, allocations: DataFrame, payments: DataFrame, params: Params, only: set[str] | None = None
) -> DataFrame:
    """The union of all lines of the ``classified`` rows.

    ``only`` limits the work to the arms that yield those branches.
    """
    arms = {
        "payments": lambda: payment_lines(rows, params),
        "allocations": lambda: allocation_lines(rows, allocations, payments, params),
    }
    wanted = set(BRANCHES) if only is None else only
    union = reduce(
        DataFrame.unionByName, [build() for arm, build in arms.items() if ARM_BRANCHES[arm] & wanted]
    )
    if only is not None:
        union = union.where(F.col("branch").isin(sorted(only)))
    listed = ", ".join(f"'{b}'" for b in BRANCHES)
    return union.withColumn("branch_ord", F.expr(f"CAST(array_position(array({listed}), branch) - 1 AS INT)"))
