"""Day arithmetic and run labels."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str | date) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def as_date(value: str | date) -> date:
    """A driver-side day from ``yyyy-MM-dd``, ``yyyyMMdd`` or a date."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def text_to_date(column: Column | str) -> Column:
    """Day of a date, timestamp or timestamp text; unreadable text is null."""
    return F.to_date(F.try_to_timestamp(_column(column).cast("string")))


def date_span(first: Column | str | date, last: Column | str | date) -> Column:
    """Array of the days first..last, both included; empty when last < first."""
    lo, hi = _column(first).cast("date"), _column(last).cast("date")
    days = F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))
    return F.when(lo <= hi, days).when(lo > hi, F.array().cast("array<date>"))


def days_before(day: Column | str | date, n: int) -> Column:
    return F.date_sub(_column(day), n)


def compact_date(day: Column | str | date) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(_column(day), "yyyyMMdd")


def run_label(at: Column | str | None = None) -> Column:
    """``HH-mm`` of a run's start."""
    return F.date_format(F.current_timestamp() if at is None else _column(at), "HH-mm")
