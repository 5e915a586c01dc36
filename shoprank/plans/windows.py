"""Nested look-back windows around a label month (driver-side dates)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from ..functions.dates import add_months


@dataclass(frozen=True)
class Win:
    """An inclusive date window; ``label`` names it in feature columns."""

    label: str
    begin: date
    end: date

    @property
    def months(self) -> int:
        return int(self.label) if self.label.isdigit() else 0


@dataclass(frozen=True)
class Windows:
    label_begin: date
    label_end: date
    feature_end: date
    features: tuple[Win, ...]


def feature_windows(label_begin: date, months: tuple[int, ...] = (1, 3, 6)) -> Windows:
    """Label window = one month from ``label_begin``; feature windows end the day before."""
    label_end = add_months(label_begin, 1) - timedelta(days=1)
    feature_end = label_begin - timedelta(days=1)
    wins = tuple(Win(str(k), add_months(label_begin, -k), feature_end) for k in months)
    return Windows(label_begin, label_end, feature_end, wins)
