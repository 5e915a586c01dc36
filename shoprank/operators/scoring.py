"""Submission scoring.

``S1 = sum(w_i * o_i) / sum(w_i)`` with ``w_i = 1 / (1 + ln i)`` over list
positions ``i`` and ``o_i`` = the user is in the truth; ``S2`` = sum over hits
of ``10 / (10 + d^2)`` divided by the truth size, ``d`` the day difference;
``S = alpha * S1 + (1 - alpha) * S2``.

One plan for every size: the truth is aggregated to one row per user and
left-joined to the list, so each position of the list counts once and S1 lies
between 0 and 1. A user who repeats in the truth counts once in the
membership test (J12); every row of the truth counts in S2, as a hit with its
own day difference and in the divisor, so the per-user row carries the sum
over its dates as ``(date, rows)`` pairs, at most one per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mathx import date_closeness, rank_weight

ALPHA = 0.4  # fixed value: weight of S1 in the blend


def score(truth: DataFrame, pred: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row ``(s1, s2, s)``.

    ``truth``: ``user_id, order_date``; ``pred``: ``user_id, pred_date, rank``
    with 1-based ranks (S1 is normalised by the list's own length).
    """
    days = truth.groupBy("user_id", "order_date").agg(F.count(F.lit(1)).alias("n"))
    users = days.groupBy("user_id").agg(
        F.collect_list(F.struct("order_date", "n")).alias("days"))  # bounded by the days of the label month
    j = pred.select("user_id", "pred_date", "rank").join(users, "user_id", "left")
    close = F.aggregate(
        F.col("days"), F.lit(0.0),
        lambda acc, x: acc + x["n"] * F.coalesce(date_closeness(F.datediff(F.col("pred_date"), x["order_date"])), F.lit(0.0)))
    w = rank_weight(F.col("rank"))
    hit = F.col("days").isNotNull()  # J12 membership / J13 hit
    sums = j.agg(
        F.sum(F.when(hit, w).otherwise(F.lit(0.0))).alias("sw_hit"),
        F.sum(w).alias("sw"),
        F.sum(F.when(hit, close).otherwise(F.lit(0.0))).alias("sfu"),
    )
    n_truth = truth.agg(F.count(F.lit(1)).alias("n")).scalar()
    s1 = F.coalesce(F.col("sw_hit") / F.nullif(F.col("sw"), F.lit(0.0)), F.lit(0.0))
    s2 = F.coalesce(F.col("sfu") / F.nullif(n_truth, F.lit(0)), F.lit(0.0))
    return sums.select(s1.alias("s1"), s2.alias("s2")).select(
        "s1", "s2", (F.lit(alpha) * F.col("s1") + F.lit(1 - alpha) * F.col("s2")).alias("s"))
