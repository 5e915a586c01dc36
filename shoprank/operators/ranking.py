"""Ranked, dated submissions.

The cut to the top ``n`` runs first (``orderBy(...).limit(n)`` is planned as
a per-partition top-k plus one bounded merge), and only then are positions
numbered, so the single-partition numbering window sees at most ``n`` rows.
Ties are broken by ``user_id`` ascending (N13).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import add_days_floor, add_days_trunc, cap_date, month_mid
from ..functions.mathx import decay
from ..functions.predicates import invalidate_pair

# Regularity weight scales and shares of the 1/3/6-month gap deviations.
REGULARITY = (("1", 4.9, 2.0), ("3", 12.5, 3.0), ("6", 21.2, 6.0))
SUBMISSION_SIZE = 50_000


def regularity_weight(features: DataFrame, fmt: str = "OM{k}_o_date_cate_30_101_gap_var") -> Column:
    """``exp(-g1/4.9)/2 + exp(-g3/12.5)/3 + exp(-g6/21.2)/6``; a missing gap adds 0."""
    terms = [decay(F.col(fmt.format(k=k)), scale) / F.lit(share) for k, scale, share in REGULARITY]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def top_ranked(df: DataFrame, score: str, n: int) -> DataFrame:
    """K1 + W3: the ``n`` highest scores (ties by user_id) with a 1-based ``rank``."""
    order = [F.desc_nulls_last(score), F.asc("user_id")]
    top = df.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("long"))


def submission_baseline(pred: DataFrame, begin: date, cap: date, n: int = SUBMISSION_SIZE,
                        score: str = "Label_30_101_BuyNum", day: str = "Label_30_101_FirstTime") -> DataFrame:
    """X9 baseline: rank by predicted count; date = begin + int(day + 0.49 - 1), capped."""
    top = top_ranked(pred, score, n)
    d = add_days_trunc(begin, F.col(day) + F.lit(0.49) - F.lit(1))
    return top.select("user_id", cap_date(d, cap).alias("pred_date"), "rank")


def submission_refactored(pred: DataFrame, begin: date, n: int = SUBMISSION_SIZE,
                          score: str = "order_num", day: str = "pred_date") -> DataFrame:
    """X9 refactored: rank by predicted count; date = begin + predicted days (floored)."""
    top = top_ranked(pred, score, n)
    return top.select("user_id", add_days_floor(begin, F.col(day)).alias("pred_date"), "rank")


def submission_prototype(pred: DataFrame, begin: date, end: date, n: int = SUBMISSION_SIZE) -> DataFrame:
    """X9 prototype: per-group (day, count) pairs -> one ranked, dated list.

    Pairs with a value below 0.5 are blanked (F14); the date is the earliest
    valid day over groups and the count the sum of valid counts (N14); users
    without a valid day are dropped; dates are capped at the window mid-point.
    """
    groups = [c[len("pred_date_"):] for c in pred.columns if c.startswith("pred_date_")]
    days, nums = [], []
    for g in groups:
        dcol, ncol = invalidate_pair(f"pred_date_{g}", f"order_num_{g}")
        days.append(dcol)
        nums.append(ncol)
    first = F.least(*days) if len(days) > 1 else days[0]
    total = sum((F.coalesce(x, F.lit(0)) for x in nums[1:]), F.coalesce(nums[0], F.lit(0)))
    merged = pred.select("user_id", first.alias("day"), total.alias("score")).where(F.col("day").isNotNull())
    top = top_ranked(merged, "score", n)
    d = cap_date(add_days_floor(begin, F.col("day")), month_mid(begin, end))
    return top.select("user_id", d.alias("pred_date"), "rank")
