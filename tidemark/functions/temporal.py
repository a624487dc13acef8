"""Time expressions on TIMESTAMP_NTZ columns. None of them depends on the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def moment(when: datetime | date | str) -> Column:
    """A literal wall-clock time. Passed as text: a Python datetime would go through the machine's zone."""
    return F.lit(when if isinstance(when, str) else when.isoformat()).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return ts.cast("date")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def shift(ts: Column, amount: Column | int, unit: str) -> Column:
    """``ts`` moved by whole months (end of month clipped, time of day kept) or days."""
    n = amount.cast("int") if isinstance(amount, Column) else F.lit(amount)
    step = F.make_interval(months=n) if unit == "month" else F.make_interval(days=n)
    return (ts + step).cast("timestamp_ntz")


def elapsed_days(earlier: Column, later: Column) -> Column:
    """Whole 24-hour days from ``earlier`` to ``later``, floored for ``later`` >= ``earlier``."""
    return F.date_part(F.lit("DAY"), later - earlier)


def month_start(ts: Column) -> Column:
    return F.trunc(day_of(ts), "month")


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def half_of_day(ts: Column) -> Column:
    """0 before noon, 1 from noon. Window midpoints of midnight-aligned windows fall on a half day."""
    return F.when(F.hour(ts) < 12, 0).otherwise(1)
