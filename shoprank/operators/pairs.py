"""Action-to-order gap (J9 + A36) without emitting action x order pairs.

The reference joins every action of a user and item with every order of the
same user and item, keeps pairs whose order date is on/after (``>=``,
refactored) or after (``>``, baseline) the action date, and averages the
day difference per user. A heavy (user, item) with m actions and n orders
would emit m x n rows. Here both sides are first counted per (user, item,
day); a running sum over the days of one (user, item) — at most one row per
day of the window hull, a bound set by the window length — gives, for every
order day, how many earlier actions there are and the sum of their days:

    pairs(o)   = no(o) * A(<= o)          A = action count up to o
    gapsum(o)  = no(o) * (A(<= o) * o - S(<= o))   S = sum of action days

Summing over order days per user gives the exact mean without any pair.
Windows are applied to both dates: an action day below the window start is
left out of the running sums of that window.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.windows import Win

EPOCH = date(1970, 1, 1)


def action_order_gap(
    action: DataFrame,
    order: DataFrame,
    windows: tuple[Win, ...],
    names: dict[str, str],
    strict: bool,
    match_category: bool = False,
    key: str = "user_id",
) -> DataFrame:
    """Mean days from action to order per user, one column per window.

    ``names`` maps window label -> output column. ``strict`` keeps pairs with
    order date > action date (baseline), else >= (refactored). With
    ``match_category`` the pairing key also holds ``cate`` and unknown
    categories never pair, as in the refactored pipeline where the order
    side has category -1 for unknown items and the action side NULL.
    """
    lo = min(w.begin for w in windows)
    hi = max(w.end for w in windows)
    keys = [key, "sku_id"] + (["cate"] if match_category else [])

    a = action.where(F.col("a_date").between(F.lit(lo), F.lit(hi)))
    o = order.where(F.col("o_date").between(F.lit(lo), F.lit(hi)))
    if match_category:
        a = a.where(F.col("cate").isNotNull())
        o = o.where(F.col("cate").isNotNull())
    a = a.select(*keys, F.unix_date("a_date").alias("d"), F.lit(1).alias("na"), F.lit(0).alias("no"))
    o = o.select(*keys, F.unix_date("o_date").alias("d"), F.lit(0).alias("na"), F.lit(1).alias("no"))
    daily = (a.unionByName(o).groupBy(*keys, "d")
             .agg(F.sum("na").cast("long").alias("na"), F.sum("no").cast("long").alias("no")))

    # Running sums over the days of one (user, item[, category]); SQL text keeps
    # plan construction to one call per expression.
    part = ", ".join(keys)
    frame = f"OVER (PARTITION BY {part} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND {'1 PRECEDING' if strict else 'CURRENT ROW'})"
    cols, aggs = [], []
    for w in windows:
        b = (w.begin - EPOCH).days
        e = (w.end - EPOCH).days
        k = w.label
        cols.append(f"coalesce(sum(CASE WHEN d >= {b} THEN na ELSE 0 END) {frame}, 0) AS c_{k}")
        cols.append(f"coalesce(sum(CASE WHEN d >= {b} THEN na * d ELSE 0 END) {frame}, 0) AS s_{k}")
        o_in = f"d BETWEEN {b} AND {e} AND no > 0"
        pairs = f"sum(CASE WHEN {o_in} THEN no * c_{k} END)"
        gaps = f"sum(CASE WHEN {o_in} THEN no * (c_{k} * d - s_{k}) END)"
        aggs.append(F.expr(f"CASE WHEN {pairs} > 0 THEN CAST({gaps} AS DOUBLE) / {pairs} END").alias(names[k]))
    running = daily.selectExpr("*", *cols)
    return running.groupBy(key).agg(*aggs)


def refactored_action_order_features(action_fact: DataFrame, order_fact: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X4 refactored: ``{k}mo_action_order_all_date_gap`` (pairs with o_date >= a_date)."""
    names = {w.label: f"{w.label}mo_action_order_all_date_gap" for w in windows}
    return action_order_gap(action_fact, order_fact, windows, names, strict=False, match_category=True)


def baseline_action_order_features(actions: DataFrame, orders: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X4 baseline: ``GM{k}_action2order_diff`` in days (pairs with o_date > a_date)."""
    names = {w.label: f"GM{w.label}_action2order_diff" for w in windows}
    return action_order_gap(actions, orders, windows, names, strict=True, match_category=False)

