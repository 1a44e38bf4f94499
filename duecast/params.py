"""Run parameters shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Params:
    """Settings of one run. The defaults are the ones the business uses."""

    currency: int = 346
    """Only invoices in this currency become ledger lines."""

    as_of: datetime = datetime(2021, 2, 1)
    """Lateness of unpaid lines is measured at this moment."""

    paid_tolerance: str = "0.01"
    """A line is paid when no more than this is open."""

    fill_missing_duedate: bool = False
    """Fill a null due date from the payment term instead of dropping the line."""

    dedupe_installments: bool = False
    """Keep only the payment lines of an invoice paid in instalments and leave
    out its (payment x allocation) lines."""

    require_split_invoices: bool = False
    """Drop tenants that have no invoice with more than one line."""

    change_column: str = "created"
    """Column compared with the high-water mark by incremental loads."""

    hot_group_rows: int = 1_000_000
    """A group with more rows than this is never handled by a single task."""

    seed: int = 7
