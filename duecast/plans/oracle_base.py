"""The shared part of the SQL oracles: derived ledger, settlement, facts."""

SOURCES = """
base AS (
  SELECT o_orderkey AS id, o_custkey AS bp, CAST(c_nationkey % 4 AS BIGINT) AS cl,
         CAST(c_nationkey AS BIGINT) AS org, o_orderdate AS d,
         CAST(o_totalprice AS DECIMAL(18,2)) AS gt, o_orderkey % 12 AS k,
         substr(o_orderpriority, 1, 1) AS pr
  FROM orders JOIN customer ON o_custkey = c_custkey),
c_paymentterm AS (
  SELECT CAST(t.term AS BIGINT) AS c_paymentterm_id, u.cl AS ad_client_id,
         CAST(15 * t.term AS BIGINT) AS netdays, TIMESTAMP '1994-12-31 00:00:00' AS created
  FROM (VALUES (1), (2), (3), (4), (5)) AS t(term)
  CROSS JOIN (SELECT DISTINCT CAST(c_nationkey % 4 AS BIGINT) AS cl FROM customer) AS u),
c_invoice AS (
  SELECT id AS c_invoice_id, cl AS ad_client_id, org AS ad_org_id, d AS dateinvoiced,
    bp AS c_bpartner_id, bp % 7 AS c_bpartner_location_id,
    CAST(CASE WHEN id % 29 = 0 THEN 100 ELSE 346 END AS BIGINT) AS c_currency_id,
    pr AS paymentrule, 1 + id % 5 AS c_paymentterm_id, gt AS grandtotal,
    CASE WHEN k IN (0, 1) THEN 1000000 + id * 10 END AS c_payment_id,
    CASE WHEN k = 7 THEN 9000000 + id END AS c_cashline_id,
    CASE WHEN id % 31 = 0 THEN NULL WHEN id % 37 = 0 THEN d - INTERVAL '5' DAY
         ELSE d + INTERVAL '15' DAY * CAST(1 + id % 5 AS INT) END AS duedate,
    CAST(CASE k WHEN 4 THEN gt WHEN 2 THEN gt * 0.6 WHEN 8 THEN gt * 0.5 WHEN 10 THEN gt * 0.4
         WHEN 11 THEN gt * 0.4 ELSE 0 END AS DECIMAL(18,2)) AS totalopenamt,
    CAST(CASE k WHEN 4 THEN 0 WHEN 2 THEN gt * 0.4 WHEN 3 THEN gt * 1.1 WHEN 8 THEN gt * 0.5
         WHEN 10 THEN gt * 0.6 WHEN 11 THEN gt * 0.6 ELSE gt END AS DECIMAL(18,2)) AS paidamt,
    CASE WHEN id % 41 = 0 THEN 'N' ELSE 'Y' END AS issotrx,
    CASE WHEN id % 43 = 0 THEN 'DR' ELSE 'CO' END AS docstatus,
    CASE WHEN id % 47 = 0 THEN 'Y' ELSE 'N' END AS isreturntrx,
    d + INTERVAL '1' DAY AS created
  FROM base),
c_payment AS (
  SELECT 1000000 + id * 10 + s AS c_payment_id, cl AS ad_client_id, org AS ad_org_id,
    CASE WHEN id % 67 = 0 THEN NULL
         WHEN k = 1 OR (k IN (2, 5, 6, 8, 9, 10) AND id % 5 = 0) THEN d - INTERVAL '3' DAY
         ELSE d + INTERVAL '1' DAY * CAST(5 + (id * 7 + s * 13) % 90 AS INT) END AS datetrx,
    CAST(500 + id % 3 AS BIGINT) AS c_doctype_id, bp AS c_bpartner_id,
    CASE WHEN k IN (0, 1, 2, 3, 5) THEN id END AS c_invoice_id,
    CASE id % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'A' ELSE 'C' END AS tendertype,
    CAST(346 AS BIGINT) AS c_currency_id, gt AS payamt, 'Y' AS isallocated,
    d + INTERVAL '30' DAY AS duedate,
    CAST(CASE WHEN k = 5 AND s = 0 THEN gt * 0.7 WHEN k = 5 THEN gt * 0.3 WHEN k = 2 THEN gt * 0.4
         WHEN k = 3 THEN gt * 1.1 ELSE gt END AS DECIMAL(18,2)) AS allocatedamt,
    CASE WHEN id % 53 = 0 THEN 'N' ELSE 'Y' END AS isreceipt,
    CASE WHEN id % 59 = 0 THEN 'DR' ELSE 'CO' END AS docstatus,
    d + INTERVAL '2' DAY AS created
  FROM base CROSS JOIN (VALUES (0), (1)) AS v(s)
  WHERE k NOT IN (4, 7, 11) AND (s = 0 OR k IN (5, 9, 10))),
c_allocationline AS (
  SELECT 5000000 + id * 10 + s AS c_allocationline_id, cl AS ad_client_id, org AS ad_org_id,
    id AS c_invoice_id, bp AS c_bpartner_id,
    CASE WHEN k IN (7, 11) OR s = 2 THEN NULL ELSE 1000000 + id * 10 + s END AS c_payment_id,
    CASE WHEN k = 7 OR s = 2 THEN 9000000 + id END AS c_cashline_id,
    CAST(CASE WHEN id % 61 = 0 THEN -gt WHEN k IN (6, 7) THEN gt WHEN k = 8 THEN gt * 0.5
         WHEN k IN (5, 9) AND s = 0 THEN gt * 0.5 WHEN k IN (5, 9) AND s = 1 THEN gt * 0.3
         WHEN k IN (5, 9, 10) THEN gt * 0.2 ELSE gt * 0.3 END AS DECIMAL(18,2)) AS amount,
    d + INTERVAL '3' DAY AS created
  FROM base CROSS JOIN (VALUES (0), (1), (2)) AS v(s)
  WHERE (s = 0 AND k IN (6, 7, 8)) OR k IN (5, 9, 10) OR (s = 0 AND id % 24 = 23))"""

CLEANED = """
inv AS (
  SELECT c_invoice_id, ad_client_id, ad_org_id, dateinvoiced, c_bpartner_id, c_bpartner_location_id,
    c_currency_id, paymentrule, c_paymentterm_id, grandtotal,
    coalesce(c_payment_id, 0) AS c_payment_id, coalesce(c_cashline_id, 0) AS c_cashline_id,
    duedate, totalopenamt, paidamt, created
  FROM c_invoice
  WHERE ad_client_id <> 0 AND issotrx = 'Y' AND docstatus = 'CO' AND isreturntrx = 'N'),
pay AS (
  SELECT c_payment_id, ad_client_id, ad_org_id, datetrx, c_doctype_id,
    coalesce(c_bpartner_id, 0) AS c_bpartner_id, coalesce(c_invoice_id, 0) AS c_invoice_id,
    tendertype, c_currency_id, payamt, isallocated, duedate, allocatedamt, created
  FROM c_payment WHERE ad_client_id <> 0 AND isreceipt = 'Y' AND docstatus = 'CO'),
alloc AS (
  SELECT c_allocationline_id, ad_client_id, ad_org_id, coalesce(c_invoice_id, 0) AS c_invoice_id,
    coalesce(c_bpartner_id, 0) AS c_bpartner_id, coalesce(c_payment_id, 0) AS c_payment_id,
    coalesce(c_cashline_id, 0) AS c_cashline_id, amount, created
  FROM c_allocationline WHERE ad_client_id <> 0 AND amount > 0),
term AS (SELECT * FROM c_paymentterm WHERE ad_client_id <> 0)"""

STAGES = """
invt AS (
  SELECT i.*, t.netdays, i.dateinvoiced + INTERVAL '1' DAY * CAST(t.netdays AS INT) AS duedate_calculated
  FROM inv i LEFT JOIN term t USING (c_paymentterm_id, ad_client_id)
  WHERE i.dateinvoiced <= i.duedate),
s1 AS (
  SELECT i.ad_client_id, i.ad_org_id, i.dateinvoiced, i.c_bpartner_id, i.c_invoice_id,
    i.c_bpartner_location_id, i.c_currency_id, i.paymentrule, i.grandtotal, i.c_payment_id,
    i.c_cashline_id, i.duedate, i.totalopenamt, i.paidamt,
    p.c_payment_id AS paym, p.datetrx, p.c_doctype_id, p.tendertype, p.payamt, p.isallocated,
    p.allocatedamt,
    CASE WHEN i.paidamt = p.allocatedamt AND i.paidamt = i.grandtotal THEN 'fully_paid'
         WHEN i.paidamt = p.allocatedamt THEN 'partially_paid'
         WHEN p.datetrx IS NOT NULL THEN 'partially_paid_2'
         WHEN i.paidamt = 0 THEN 'unpaid_invoices' ELSE 'residual' END AS branch,
    i.grandtotal - i.paidamt AS bal
  FROM invt i LEFT JOIN pay p ON p.c_invoice_id = i.c_invoice_id AND p.ad_client_id = i.ad_client_id),
s2 AS (
  SELECT s1.* EXCLUDE (branch), a.c_allocationline_id, a.c_payment_id AS py, a.c_cashline_id AS cy,
    a.amount,
    CASE WHEN a.amount IS NULL THEN 'no_allocation'
         WHEN paidamt = amount AND paidamt = grandtotal AND a.c_cashline_id <> 0 AND a.c_payment_id = 0 THEN 'cash_paid'
         WHEN paidamt = amount AND paidamt = grandtotal THEN 'fp2'
         WHEN paidamt = amount AND a.c_payment_id <> 0 THEN 'p2'
         WHEN paidamt = grandtotal AND a.c_cashline_id <> 0 THEN 'cash_paid2'
         WHEN paidamt = grandtotal THEN 'p3'
         WHEN a.c_payment_id = 0 AND a.c_cashline_id = 0 THEN 'unsupported'
         WHEN a.c_cashline_id <> 0 THEN 'cash_paid3' ELSE 'p4' END AS branch
  FROM s1 LEFT JOIN alloc a ON a.c_invoice_id = s1.c_invoice_id AND a.ad_client_id = s1.ad_client_id
  WHERE s1.branch = 'residual'),
s3 AS (
  SELECT s1.* EXCLUDE (branch), a.c_allocationline_id, a.c_payment_id AS py, a.c_cashline_id AS cy,
    a.amount, CASE WHEN a.c_cashline_id = 0 THEN 'p1' ELSE 'cash_paid4' END AS branch
  FROM s1 LEFT JOIN alloc a ON a.c_invoice_id = s1.c_invoice_id AND a.ad_client_id = s1.ad_client_id
  WHERE s1.branch = 'partially_paid_2' AND s1.grandtotal = s1.paidamt),
s2pay AS (
  SELECT s2.* EXCLUDE (datetrx, c_doctype_id, tendertype, isallocated),
    q.datetrx, q.c_doctype_id, q.tendertype, q.isallocated,
    CASE WHEN s2.branch = 'p2' AND bal < 0 THEN amount + bal ELSE amount END AS am
  FROM s2 LEFT JOIN pay q ON q.c_payment_id = s2.py AND q.ad_client_id = s2.ad_client_id
  WHERE s2.branch IN ('fp2', 'p2', 'p3', 'p4')
    AND NOT coalesce(q.datetrx < s2.dateinvoiced, FALSE)
    AND (s2.branch = 'p2' OR q.datetrx IS NOT NULL))"""

_HEAD = "ad_client_id, ad_org_id, dateinvoiced, c_bpartner_id, c_invoice_id, c_bpartner_location_id, c_currency_id, paymentrule"


def _line(branch: str, ordinal: str, source: str, where: str, **values: str) -> str:
    """One SELECT of ledger lines; values not named are the columns of the stage."""
    columns = {
        "grandtotal": "grandtotal", "c_payment_id": "c_payment_id", "c_cashline_id": "c_cashline_id",
        "duedate": "duedate", "totalopenamt": "totalopenamt", "paidamt": "paidamt", "paym": "paym",
        "datetrx": "datetrx", "c_doctype_id": "c_doctype_id", "tendertype": "tendertype",
        "payamt": "payamt", "isallocated": "isallocated", "allocatedamt": "allocatedamt",
        "c_allocationline_id": "c_allocationline_id", "source_payment_id": "NULL",
    }
    columns.update(values)
    money = ("grandtotal", "totalopenamt", "paidamt", "payamt", "allocatedamt")
    ids = ("paym", "c_doctype_id", "c_allocationline_id", "source_payment_id")

    def cast(name: str, value: str) -> str:
        if name in money:
            return f"CAST({value} AS DECIMAL(18,2)) AS {name}"
        if name in ids:
            return f"CAST({value} AS BIGINT) AS {name}"
        if name == "datetrx":
            return f"CAST({value} AS TIMESTAMP) AS {name}"
        if name in ("tendertype", "isallocated"):
            return f"CAST({value} AS VARCHAR) AS {name}"
        return f"{value} AS {name}"

    picked = ", ".join(cast(n, v) for n, v in columns.items())
    return f"SELECT {_HEAD}, {picked}, '{branch}' AS branch, {ordinal} AS branch_ord FROM {source} WHERE {where}"


def _lines() -> str:
    on_time = "NOT coalesce(datetrx < dateinvoiced, FALSE)"
    cap = "CASE WHEN bal < 0 THEN allocatedamt + bal ELSE allocatedamt END"
    no_payment = dict(
        allocatedamt="NULL", datetrx="NULL", payamt="NULL", tendertype="NULL",
        c_doctype_id="NULL", isallocated="NULL", paym="NULL",
    )
    balance = dict(grandtotal="bal", totalopenamt="bal", paidamt="0", **no_payment)
    no_alloc = dict(c_allocationline_id="NULL", source_payment_id="paym")

    def all_of(value: str) -> dict[str, str]:
        return dict(grandtotal=value, totalopenamt=value, paidamt=value, allocatedamt=value)

    cash = dict(payamt="amount", allocatedamt="amount", datetrx="dateinvoiced", c_cashline_id="cy")
    found = dict(paym="c_payment_id", c_payment_id="py", payamt="am", allocatedamt="am")
    selects = [
        _line("fully_paid", "0", "s1", f"branch = 'fully_paid' AND {on_time}", **no_alloc),
        _line("partially_paid", "1", "s1", f"branch = 'partially_paid' AND {on_time}", **no_alloc,
              payamt=cap, **all_of(cap)),
        _line("unpaid_balance", "2", "s1",
              f"branch = 'partially_paid' AND {on_time} AND NOT coalesce(bal < 0, FALSE)", **no_alloc, **balance),
        _line("partially_paid_2", "3", "s1", "branch = 'partially_paid_2'", **no_alloc,
              grandtotal="allocatedamt", totalopenamt="allocatedamt", paidamt="allocatedamt"),
        _line("cash_paid", "4", "s2", "branch = 'cash_paid'", **cash),
        _line("p1", "5", "s3", "branch = 'p1'", source_payment_id="paym", **all_of("amount")),
        _line("unpaid_invoices", "6", "s1", "branch = 'unpaid_invoices'", c_allocationline_id="NULL"),
        _line("cash_paid4", "7", "s3", "branch = 'cash_paid4'", source_payment_id="paym", **all_of("amount"),
              payamt="amount", datetrx="dateinvoiced", c_cashline_id="cy", paym="NULL", c_doctype_id="NULL",
              tendertype="NULL", isallocated="NULL"),
        _line("fp2", "8", "s2pay", "branch = 'fp2'", **found),
        _line("unpaid_balance2", "9", "s2", "branch = 'p2' AND NOT coalesce(bal < 0, FALSE)", **balance),
        _line("p2", "10", "s2pay", "branch = 'p2'", **{**found, **all_of("am")}),
        _line("cash_paid2", "11", "s2", "branch = 'cash_paid2'", **cash, grandtotal="amount", totalopenamt="amount"),
        _line("cash_paid3", "12", "s2", "branch = 'cash_paid3'", **{**cash, **all_of("amount")}),
        _line("p3", "13", "s2pay", "branch = 'p3'", **{**found, **all_of("am")}),
        _line("p4", "14", "s2pay", "branch = 'p4'", **{**found, **all_of("am")}),
    ]
    union = "\n  UNION ALL ".join(selects)
    return f"""
both_sides AS (
  SELECT ad_client_id FROM inv INTERSECT SELECT ad_client_id FROM pay INTERSECT SELECT ad_client_id FROM alloc),
all_lines AS (
  {union}),
lines AS (
  SELECT * FROM all_lines
  WHERE c_currency_id = 346 AND ad_client_id IN (SELECT ad_client_id FROM both_sides))"""


FACTS = """
ids AS (
  SELECT *, c_invoice_id AS src_invoice_id,
    row_number() OVER (PARTITION BY ad_client_id, c_invoice_id
      ORDER BY branch_ord, c_allocationline_id NULLS FIRST, source_payment_id NULLS FIRST) - 1 AS line_no,
    count(*) OVER (PARTITION BY ad_client_id, c_invoice_id) AS line_count
  FROM lines),
named AS (
  SELECT * EXCLUDE (c_invoice_id),
    CASE WHEN line_count > 1 THEN CAST(src_invoice_id AS VARCHAR) || '_' || CAST(line_no AS VARCHAR)
         ELSE CAST(src_invoice_id AS VARCHAR) END AS c_invoice_id
  FROM ids),
facts0 AS (
  SELECT *,
    greatest(CAST(floor((epoch(coalesce(datetrx, TIMESTAMP '2001-02-01')) - epoch(duedate)) / 86400) AS BIGINT), 0) AS dayslate,
    CAST(floor((epoch(datetrx) - epoch(dateinvoiced)) / 86400) AS BIGINT) AS daystosettle,
    CASE WHEN grandtotal - paidamt <= 0.01 THEN 1 ELSE 0 END AS paid
  FROM named
  WHERE NOT coalesce(datetrx < dateinvoiced, FALSE) AND grandtotal > 0),
facts AS (SELECT *, CASE WHEN dayslate > 0 THEN 1 ELSE 0 END AS late FROM facts0),
lined AS (
  SELECT *, CASE WHEN late = 1 AND paid = 1 THEN 1 ELSE 0 END AS closed_late_invoice,
    allocatedamt * late AS paid_late_sum,
    CASE WHEN late = 1 AND paid = 1 THEN dayslate ELSE 0 END AS days_late_closed_invoices_late,
    late * (1 - paid) AS invoice_late_unpaid, grandtotal - paidamt AS unpaid_sum,
    (grandtotal - paidamt) * late AS unpaid_late_sum
  FROM facts),
partner AS (
  SELECT ad_client_id, c_bpartner_id, count(*) AS total_invoices,
    CAST(sum(paid) AS BIGINT) AS closed_invoices_no,
    CAST(sum(closed_late_invoice) AS BIGINT) AS closed_late_invoices_no,
    CASE WHEN sum(paid) <> 0 THEN CAST(sum(closed_late_invoice) AS DOUBLE) / CAST(sum(paid) AS DOUBLE) END AS paid_late_percent,
    coalesce(sum(allocatedamt), 0) AS paid_total,
    coalesce(sum(paid_late_sum), 0) AS paid_late_total,
    CASE WHEN coalesce(sum(allocatedamt), 0) <> 0
         THEN CAST(coalesce(sum(paid_late_sum), 0) AS DOUBLE) / CAST(sum(allocatedamt) AS DOUBLE) END AS paid_late_raport_percent,
    CASE WHEN count(*) FILTER (days_late_closed_invoices_late <> 0) = 0 THEN 0
         ELSE CAST(sum(days_late_closed_invoices_late) AS DOUBLE)
              / count(*) FILTER (days_late_closed_invoices_late <> 0) END AS avg_days_paid_late,
    CAST(count(*) - sum(paid) AS BIGINT) AS unpaid_invoices_no,
    CAST(sum(invoice_late_unpaid) AS BIGINT) AS late_unpaid_invoices_no,
    CASE WHEN count(*) = sum(paid) THEN 0
         ELSE CAST(sum(invoice_late_unpaid) AS DOUBLE) / CAST(count(*) - sum(paid) AS DOUBLE) END AS late_unpaid_invoices_percent,
    sum(unpaid_sum) AS unpaid_invoices_sum, sum(unpaid_late_sum) AS unpaid_invoices_late_sum,
    CASE WHEN sum(unpaid_sum) <> 0
         THEN CAST(sum(unpaid_late_sum) AS DOUBLE) / CAST(sum(unpaid_sum) AS DOUBLE) END AS late_unpaid_invoices_sum_percent,
    max(allocatedamt) AS max_paid, min(allocatedamt) AS min_paid,
    CAST(sum(allocatedamt) AS DOUBLE) / count(allocatedamt) AS avg_paid,
    stddev_samp(CAST(allocatedamt AS DOUBLE)) AS std_paid,
    max(paid_late_sum) AS max_late_paid, min(paid_late_sum) AS min_late_paid,
    CAST(sum(paid_late_sum) AS DOUBLE) / count(paid_late_sum) AS avg_late_paid,
    stddev_samp(CAST(paid_late_sum AS DOUBLE)) AS std_late_paid,
    max(unpaid_sum) AS max_unpaid, min(unpaid_sum) AS min_unpaid,
    CAST(sum(unpaid_sum) AS DOUBLE) / count(unpaid_sum) AS avg_unpaid,
    stddev_samp(CAST(unpaid_sum AS DOUBLE)) AS std_unpaid,
    max(unpaid_late_sum) AS max_late_unpaid, min(unpaid_late_sum) AS min_late_unpaid,
    CAST(sum(unpaid_late_sum) AS DOUBLE) / count(unpaid_late_sum) AS avg_late_unpaid,
    stddev_samp(CAST(unpaid_late_sum AS DOUBLE)) AS std_late_unpaid
  FROM lined GROUP BY 1, 2),
full_facts AS (SELECT * FROM lined JOIN partner USING (ad_client_id, c_bpartner_id))"""

PRELUDE = "WITH " + ",".join([SOURCES, CLEANED, STAGES, _lines(), FACTS])


def statement(body: str, *more_ctes: str) -> str:
    """A complete statement: the shared prelude, further CTEs and the query."""
    return ",\n".join([PRELUDE, *more_ctes]) + "\n" + body
