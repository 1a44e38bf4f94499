"""Small hand-made source tables."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from duecast.schemas import SOURCES


def day(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d")


def _table(spark, entity, rows, defaults):
    schema = SOURCES[entity]
    complete = [{**defaults, **row} for row in rows]
    money = {f.name for f in schema if f.dataType.simpleString().startswith("decimal")}
    data = [
        tuple(Decimal(str(r[n])) if n in money and r[n] is not None else r[n] for n in schema.fieldNames())
        for r in complete
    ]
    return spark.createDataFrame(data, schema)


def sources(spark, invoices=(), payments=(), allocations=(), terms=None, tenant=1):
    created = day("2020-01-11")
    common = {"ad_client_id": tenant, "ad_org_id": 10, "created": created}
    terms = [{"c_paymentterm_id": 1, "netdays": 30}] if terms is None else terms
    return {
        "c_invoice": _table(spark, "c_invoice", invoices, {
            **common, "dateinvoiced": day("2020-01-10"), "c_bpartner_id": 7, "c_bpartner_location_id": 70,
            "c_currency_id": 346, "paymentrule": "P", "c_paymentterm_id": 1, "c_payment_id": None,
            "c_cashline_id": None, "duedate": day("2020-02-10"), "totalopenamt": 0, "issotrx": "Y",
            "docstatus": "CO", "isreturntrx": "N",
        }),
        "c_payment": _table(spark, "c_payment", payments, {
            **common, "c_doctype_id": 500, "c_bpartner_id": 7, "c_invoice_id": None, "tendertype": "K",
            "c_currency_id": 346, "payamt": 1, "isallocated": "Y", "duedate": None, "isreceipt": "Y",
            "docstatus": "CO",
        }),
        "c_allocationline": _table(spark, "c_allocationline", allocations, {
            **common, "c_bpartner_id": 7, "c_payment_id": None, "c_cashline_id": None,
        }),
        "c_paymentterm": _table(spark, "c_paymentterm", terms, common),
        "ad_client": spark.createDataFrame([(tenant,)], SOURCES["ad_client"]),
    }


# The hand rows: number -> (total, paid, linked payments, allocations, unlinked
# payments, other invoice values). Payments are (amount, date); allocations are
# (amount, payment number or None, cash line); unlinked ones (number, date).
HAND = {
    1: (100, 100, [(100, "2020-02-01")], [], [], {}),
    2: (100, 100, [(100, "2020-01-05")], [], [], {}),
    3: (100, 40, [(40, "2020-02-20")], [], [], {}),
    4: (100, 110, [(110, "2020-02-01")], [], [], {}),
    5: (100, 100, [(70, "2020-02-01"), (30, "2020-02-05")], [(100, 1, 0)], [], {}),
    6: (100, 0, [], [], [], {}),
    7: (100, 100, [], [(100, None, 9)], [], {}),
    8: (100, 100, [], [(100, 5, 0)], [(5, "2020-02-15")], {}),
    9: (100, 120, [], [(120, 5, 0)], [(5, "2020-02-15")], {}),
    10: (100, 50, [], [(50, 5, 0)], [(5, "2020-02-15")], {}),
    11: (100, 50, [], [(50, 5, 0)], [(5, "2020-01-02")], {}),
    12: (100, 50, [], [(50, 5, 0)], [], {}),
    13: (100, 100, [], [(60, None, 9), (40, 5, 0)], [(5, "2020-02-15")], {}),
    14: (100, 100, [], [(60, 5, 0)], [], {}),
    15: (100, 70, [], [(30, None, 9), (40, 5, 0)], [(5, "2020-02-15")], {}),
    16: (100, 70, [], [(30, None, 0)], [], {}),
    17: (100, 70, [], [], [], {}),
    18: (100, 100, [(70, "2020-02-01"), (30, "2020-02-05")], [(100, None, 9)], [], {}),
    19: (100, 0, [], [], [], {"duedate": None}),
    20: (100, 0, [], [], [], {"duedate": day("2020-01-01")}),
}


def hand_sources(spark):
    invoices, payments, allocations = [], [], []
    for number, (total, paid, linked, allocated, unlinked, more) in HAND.items():
        invoices.append({"c_invoice_id": number, "grandtotal": total, "paidamt": paid, **more})
        for i, (amount, when) in enumerate(linked, start=1):
            payments.append({"c_payment_id": number * 100 + i, "c_invoice_id": number, "allocatedamt": amount, "datetrx": day(when)})
        for i, (amount, payment, cash) in enumerate(allocated):
            allocations.append({
                "c_allocationline_id": number * 1000 + i, "c_invoice_id": number, "amount": amount,
                "c_payment_id": None if payment is None else number * 100 + payment, "c_cashline_id": cash,
            })
        for payment, when in unlinked:
            payments.append({"c_payment_id": number * 100 + payment, "allocatedamt": 1, "datetrx": day(when)})
    return sources(spark, invoices, payments, allocations)
