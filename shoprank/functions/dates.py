"""Date helpers."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
NANOS_PER_DAY = 86_400_000_000_000


def date_parts(prefix_col: str) -> dict[str, Column]:
    """Year, month and day-of-month of a date column."""
    c = F.col(prefix_col)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole days between two dates (``later - earlier``)."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.datediff(a, b)


def floor_days_between_ts(later: str | Column, earlier: str | Column) -> Column:
    """Floored day difference of two timestamps, like ``timedelta.days``."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    micros = F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def add_days_trunc(begin: date | Column, days: Column) -> Column:
    """C3 (baseline): ``begin + int(days)``, the cast truncating toward zero."""
    b = F.lit(begin) if isinstance(begin, date) else begin
    return F.date_add(b, days.cast("int"))


def add_days_floor(begin: date | Column, days: Column) -> Column:
    """C3 (refactored): fractional day offsets floored to whole days."""
    b = F.lit(begin) if isinstance(begin, date) else begin
    return F.date_add(b, F.floor(days).cast("int"))


def cap_date(d: Column, limit: date) -> Column:
    """C4: cap a date at a limit (``least`` skips NULL, as pandas does)."""
    return F.least(d, F.lit(limit))


def to_midnight(ts: str | Column) -> Column:
    """normalise a timestamp to its date."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


def add_months(d: date, months: int) -> date:
    """C5 on the driver: calendar month arithmetic clamped to month end."""
    m = d.month - 1 + months
    y = d.year + m // 12
    m = m % 12 + 1
    last = calendar.monthrange(y, m)[1]
    return date(y, m, min(d.day, last))


def month_mid(begin: date, end: date) -> date:
    """Mid-point of a label window, whole days (prototype date cap)."""
    return begin + timedelta(days=(end - begin).days // 2)
