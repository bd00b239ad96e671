"""Lenient date parsing, calendar parts and month arithmetic.

Timestamps are TIMESTAMP_NTZ throughout, so no result depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full year-month-day with - or /, optionally followed by hours and minutes or more. Spark's
# own cast would also take '2025' or '2025-01' and ignore any text after a date.
_DATE_SHAPE = r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}([T ]\d{1,2}:\d{1,2}.*)?\s*$"


def to_ts_lenient(col: Column) -> Column:
    """Text to TIMESTAMP_NTZ; NULL when it is not a date or a date with a time."""
    text = col.cast("string")
    dashed = F.replace(text, F.lit("/"), F.lit("-"))
    return F.when(text.rlike(_DATE_SHAPE), dashed.try_cast("timestamp_ntz"))


def to_date_lenient(col: Column) -> Column:
    return F.to_date(to_ts_lenient(col))


def to_float_lenient(col: Column) -> Column:
    """Text to 32-bit float, NULL when it is not a number."""
    return col.try_cast("float")


def date_key(col: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)


def day_of_week(col: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(col) - 1


def is_weekend(col: Column, weekend_days: Iterable[int] = (1, 7)) -> Column:
    return day_of_week(col).isin(*weekend_days)


def month_start(col: Column) -> Column:
    return F.trunc(F.to_date(col), "MM")


def months_crossed(start: Column, end: Column) -> Column:
    """Signed number of month boundaries between two dates (Jan 31 -> Feb 1 is 1)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_bit(col: Column) -> Column:
    """2 to the power of the month number, so that a set of months is one integer."""
    return F.call_function("shiftleft", F.lit(1), F.month(col))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def add_months_ts(ts: Column, months: Column) -> Column:
    """Add whole months keeping the time of day, clamped to the month's last day."""
    return ts + F.make_ym_interval(F.lit(0), months)
