"""Column helpers: null rules, day arithmetic, money and ratios."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from ..schemas import MONEY


def is_true(condition: Column) -> Column:
    """The condition with null read as false, so that its negation keeps nulls."""
    return F.coalesce(condition, F.lit(False))


def money(value) -> Column:
    return (F.lit(value) if not isinstance(value, Column) else value).cast(MONEY)


def moment(value: datetime) -> Column:
    """A wall-clock literal; built from text so that no time zone enters."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def plus_days(start: Column, days: Column) -> Column:
    return start + F.make_dt_interval(days=days.cast("int"))


def _second_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def floor_days(end: Column, start: Column) -> Column:
    """Whole days from start to end, rounded down (minus two hours is -1).

    Works on the wall clock, so no time zone or daylight saving enters.
    """
    short = (_second_of_day(end) < _second_of_day(start)).cast("int")
    return (F.datediff(end.cast("date"), start.cast("date")) - short).cast("long")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; null where the division has no finite result."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
