"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decay(x: Column, scale: float) -> Column:
    """C6 + C8: ``exp(-x / scale)`` with a missing ``x`` read as +inf, i.e. 0."""
    return F.coalesce(F.exp(-x / F.lit(scale)), F.lit(0.0))


def rank_weight(rank: Column) -> Column:
    """``1 / (1 + ln(rank))`` for a 1-based list position."""
    return F.lit(1.0) / (F.lit(1.0) + F.log(rank.cast("double")))


def date_closeness(days: Column) -> Column:
    """``10 / (10 + d^2)``."""
    d = days.cast("double")
    return F.lit(10.0) / (F.lit(10.0) + d * d)


def within_tolerance(new: Column, old: Column, rtol: float, atol: float) -> Column:
    """``|new - old| <= atol + rtol * |old|``."""
    return F.abs(new - old) <= F.lit(atol) + F.lit(rtol) * F.abs(old)
