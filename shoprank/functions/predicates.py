"""Row predicates: date windows, category groups, type/score filters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two target categories and the recoding of the prototype.
TARGET_CATES = (30, 101)
RECODE = {30: 1, 101: 2}  # every other category, unknown included, becomes 0

# Action type and score codes.
VIEW, STAR = 1, 2
GOOD_SCORE, BAD_SCORE = 1, 3


def in_window(col: str | Column, begin: date, end: date) -> Column:
    """inclusive date range; compares dates, never timestamps."""
    c = F.col(col) if isinstance(col, str) else col
    return c.between(F.lit(begin), F.lit(end))


@dataclass(frozen=True)
class CateGroup:
    """A named category predicate (F2)."""

    name: str
    predicate: Column


def cate_groups(cate: str = "cate", t1: int = TARGET_CATES[0], t2: int = TARGET_CATES[1]) -> dict[str, CateGroup]:
    """The five groups ``30``, ``101``, ``30_101``, ``others``, ``all``.

    ``others`` is null-safe (N1): a row of unknown category is in ``others``,
    as a pandas ``NaN != 30`` comparison puts it there.
    """
    c = F.col(cate)
    g30 = c == t1
    g101 = c == t2
    return {
        f"{t1}": CateGroup(f"{t1}", g30),
        f"{t2}": CateGroup(f"{t2}", g101),
        f"{t1}_{t2}": CateGroup(f"{t1}_{t2}", g30 | g101),
        "others": CateGroup("others", ~c.eqNullSafe(t1) & ~c.eqNullSafe(t2)),
        "all": CateGroup("all", F.lit(True)),
    }


def recode_category(cate: str | Column = "cate") -> Column:
    """30 -> 1, 101 -> 2, anything else (NULL too) -> 0."""
    c = F.col(cate) if isinstance(cate, str) else cate
    out = F.lit(0)
    expr = None
    for raw, code in RECODE.items():
        expr = F.when(c == raw, code) if expr is None else expr.when(c == raw, code)
    return expr.otherwise(out)


def prototype_groups(code: str = "cate_code") -> dict[str, Column]:
    """Prototype groups on the recoded category (F3): 30, 101, tg, ntg."""
    c = F.col(code)
    return {"30": c == 1, "101": c == 2, "tg": c != 0, "ntg": c == 0}


def is_view(a_type: str = "a_type") -> Column:
    """F4."""
    return F.col(a_type) == VIEW


def is_star(a_type: str = "a_type") -> Column:
    """F4."""
    return F.col(a_type) == STAR


def score_rated(score: str = "score_level") -> Column:
    """a missing score is -1, so rated means > 0."""
    return F.col(score) > 0


def score_good(score: str = "score_level") -> Column:
    return F.col(score) == GOOD_SCORE


def score_bad(score: str = "score_level") -> Column:
    return F.col(score) == BAD_SCORE


def invalidate_pair(day: str, num: str) -> tuple[Column, Column]:
    """blank a (day offset, count) pair when either is below 0.5."""
    ok = (F.col(day) >= 0.5) & (F.col(num) >= 0.5)
    return F.when(ok, F.col(day)), F.when(ok, F.col(num))
