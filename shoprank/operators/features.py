"""Per-user feature builders over nested windows.

Two naming schemes are supported: the refactored pipeline (``{k}mo_order_*``,
``{k}mo_action_*``) and the baseline (``OM{k}_*``, ``AM{k}_*``). Both are lists
of :class:`~shoprank.operators.user_agg.Agg` specs compiled by
:func:`~shoprank.operators.user_agg.user_window_agg` into one scan per fact
table, whatever the number of windows and features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import cate_groups, score_good, score_rated
from ..plans.windows import Win
from .user_agg import Agg, user_window_agg

G = "30_101"


def group_predicates(cate: str = "cate") -> dict[str, Column]:
    return {name: g.predicate for name, g in cate_groups(cate).items() if name != "all"}


def refactored_order_specs(windows: tuple[Win, ...]) -> list[Agg]:
    """A1-A28 under the refactored names, with defects D1, D2 and D3 fixed."""
    specs: list[Agg] = []
    for w in windows:
        n = f"{w.label}mo_order_"
        k = w.label
        specs += [Agg(f"{n}{g}_num", "nunique", "o_id", g, k) for g in ("30_101", "30", "101", "others", "all")]
        specs += [Agg(f"{n}{g}_item_count", "count", "sku_id", g, k) for g in ("30_101", "30", "101", "others")]
        specs += [
            Agg(f"{n}all_item_num", "nunique", "sku_id", "all", k),
            Agg(f"{n}30_101_date_num", "nunique", "o_date", G, k),
            Agg(f"{n}30_101_item_sum", "sum", "o_sku_num", G, k),
            Agg(f"{n}30_101_day_first", "min", "o_day", G, k),
            Agg(f"{n}30_day_first", "min", "o_day", "30", k),
            Agg(f"{n}101_day_first", "min", "o_day", "101", k),
            Agg(f"{n}30_101_day_last", "max", "o_day", G, k),
            Agg(f"{n}30_101_day_mean", "mean", "o_day", G, k),
        ]
        if w.months > 1:
            specs.append(Agg(f"{n}30_101_month_num", "nunique", "o_month", G, k))
        specs += [
            Agg(f"{n}30_101_date_gap_var", "gap_std", "o_date", G, k),
            Agg(f"{n}30_101_area_freq", "mode", "o_area", G, k),
            Agg(f"{n}30_101_consume_total", "sum", "o_total_price", G, k),
            Agg(f"{n}30_101_date_gap_mean", "gap_mean", "o_date", G, k),
            Agg(f"{n}all_date_gap_mean", "gap_mean", "o_date", "all", k),
        ]
        if w.months > 1:
            specs.append(Agg(f"{n}30_101_month_last", "max", "o_month", G, k))
        specs += [
            Agg(f"{n}30_101_day_freq", "mode", "o_day", G, k),
            Agg(f"{n}30_101_score_count", "rows", None, "30_101_rated", k),
            Agg(f"{n}30_101_good_score_count", "rows", None, "30_101_good", k),
        ]
    return specs


def refactored_order_features(order_fact: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X2 (refactored): order features of every window from one scan of ``order_fact``."""
    preds = group_predicates()
    preds["30_101_rated"] = preds[G] & score_rated()
    preds["30_101_good"] = preds[G] & score_good()
    return user_window_agg(order_fact, refactored_order_specs(windows), windows, preds, "o_date",
                           date_parts={"o_month": "month", "o_day": "day"})


def refactored_action_specs(windows: tuple[Win, ...]) -> list[Agg]:
    """A29-A31, A33 under the refactored names."""
    specs: list[Agg] = []
    for w in windows:
        n = f"{w.label}mo_action_30_101_"
        k = w.label
        specs += [
            Agg(f"{n}sum", "sum", "a_num", G, k),
            Agg(f"{n}count", "count", "a_num", G, k),
            Agg(f"{n}date_count", "rows", None, G, k),
            Agg(f"{n}date_gap_mean", "gap_mean", "a_date", G, k),
            Agg(f"{n}day_freq", "mode", "a_day", G, k),
        ]
    return specs


def refactored_action_features(action_fact: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X3 (refactored): action features of every window from one scan."""
    return user_window_agg(action_fact, refactored_action_specs(windows), windows, group_predicates(), "a_date",
                           date_parts={"a_month": "month", "a_day": "day"})


def baseline_order_specs(windows: tuple[Win, ...]) -> list[Agg]:
    """A1-A26, A28 under the baseline names (mode of area and spend over all rows)."""
    specs: list[Agg] = []
    for w in windows:
        n = f"OM{w.label}_"
        k = w.label
        specs += [Agg(f"{n}o_id_cate_{g}_cnt", "nunique", "o_id", src, k)
                  for g, src in (("30_101", G), ("30", "30"), ("101", "101"), ("other", "others"), ("all", "all"))]
        specs += [Agg(f"{n}sku_id_cate_{g}_cnt", "count", "sku_id", src, k)
                  for g, src in (("30_101", G), ("30", "30"), ("101", "101"), ("other", "others"))]
        specs += [
            Agg(f"{n}sku_id_nunique", "nunique", "sku_id", "all", k),
            Agg(f"{n}o_date_cate_30_101_nuique", "nunique", "o_date", G, k),
            Agg(f"{n}o_sku_num_cate_30_101_sum", "sum", "o_sku_num", G, k),
            Agg(f"{n}day_cate_30_101_firstday", "min", "day", G, k),
            Agg(f"{n}day_cate_30_firstday", "min", "day", "30", k),
            Agg(f"{n}day_cate_101_firstday", "min", "day", "101", k),
            Agg(f"{n}day_cate_30_101_lastday", "max", "day", G, k),
            Agg(f"{n}day_cate_30_101_meanday", "mean", "day", G, k),
        ]
        if w.months > 1:
            specs.append(Agg(f"{n}month_cate_30_101_monthnum", "nunique", "month", G, k))
        specs += [
            Agg(f"{n}o_date_cate_30_101_gap_var", "gap_std", "o_date", G, k),
            Agg(f"{n}area_most_common", "mode", "o_area", "all", k),
            Agg(f"{n}total_consume", "sum", "total_price", "all", k),
            Agg(f"{n}o_date_cate_30_101_gap", "gap_mean", "o_date", G, k),
            Agg(f"{n}o_date_cate_all_gap", "gap_mean", "o_date", "all", k),
        ]
        if w.months > 1:
            specs.append(Agg(f"{n}month_cate_30_101_lastmonth", "max", "month", G, k))
        specs += [
            Agg(f"{n}day_most_common", "mode", "day", G, k),
            Agg(f"{n}num_comment_on_101_and_30", "count", "comment_create_tm", G, k),
            Agg(f"{n}good_score_on_30_101", "rows", None, "30_101_good", k),
        ]
    return specs


def baseline_order_features(enriched_orders: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X2 (baseline): features of the enriched order lines (J1 output)."""
    preds = group_predicates()
    preds["30_101_good"] = preds[G] & score_good()
    return user_window_agg(enriched_orders, baseline_order_specs(windows), windows, preds, "o_date",
                           date_parts={"month": "month", "day": "day"})


def baseline_action_specs(windows: tuple[Win, ...]) -> list[Agg]:
    """A32-A35 under the baseline names."""
    specs: list[Agg] = []
    for w in windows:
        n = f"AM{w.label}_"
        k = w.label
        specs += [
            Agg(f"{n}sku_id_cate_30_101_cnt", "nunique", "sku_id", G, k),
            Agg(f"{n}a_date_cate_30_101_nuique", "nunique", "a_date", G, k),
            Agg(f"{n}a_date_cate_30_101_gap", "gap_mean", "a_date", G, k),
            Agg(f"{n}day_most_common", "mode", "day", G, k),
        ]
    return specs


def baseline_action_features(enriched_actions: DataFrame, windows: tuple[Win, ...]) -> DataFrame:
    """X3 (baseline): features of the enriched actions (J2 output)."""
    return user_window_agg(enriched_actions, baseline_action_specs(windows), windows, group_predicates(), "a_date",
                           date_parts={"month": "month", "day": "day"})


def target_order_count(order_fact: DataFrame, window: Win) -> DataFrame:
    """Step-1 slice: distinct target-group orders per user in one window (A1)."""
    spec = [Agg("order_count_30_101", "nunique", "o_id", G, window.label)]
    return user_window_agg(order_fact, spec, (window,), group_predicates(), "o_date")


def anchor(users: DataFrame, *parts: DataFrame, key: str = "user_id") -> DataFrame:
    """Left-join per-user parts onto the user table (one row per user)."""
    out = users
    for p in parts:
        out = out.join(p, key, "left")
    return out


def order_columns_like_reference(df: DataFrame, first: list[str], groups: list[list[str]]) -> DataFrame:
    """Reorder columns: ``first`` then each group in turn."""
    cols = list(first)
    for g in groups:
        cols += [c for c in g if c not in cols]
    return df.selectExpr(*[f"`{c}`" for c in cols])


def successive_gaps(fact: DataFrame, date_col: str, where: Column | None = None, key: str = "user_id") -> DataFrame:
    """Day gaps between a user's successive dates, in compact form.

    The reference sorts a user's rows by date and differences neighbours, so
    a day with k rows yields k - 1 zero gaps plus one gap to the previous
    day. Here the rows are first counted per (user, day) and the window runs
    over those days only — at most one row per calendar day in the data's
    span, whatever the number of rows — giving ``(user, day, n_rows, gap)``
    with ``gap`` NULL on the user's first day.
    """
    from pyspark.sql import Window as W

    rows = fact if where is None else fact.where(where)
    days = rows.where(F.col(key).isNotNull() & F.col(date_col).isNotNull()).groupBy(key, date_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"))
    prev = F.lag(F.col(date_col)).over(W.partitionBy(key).orderBy(date_col))
    return days.select(key, date_col, "n_rows", F.datediff(F.col(date_col), prev).cast("long").alias("gap"))


def group_line_counts(fact: DataFrame, windows: tuple[Win, ...], date_col: str = "o_date") -> DataFrame:
    """F1 + F2: ``(window, grp, n_lines, n_users)`` for the five category groups.

    One pass: each row is tagged with the (window, group) pairs it belongs to
    and counted; distinct users come from a second, pre-aggregated level.
    """
    groups = cate_groups()
    tags = []
    for w in windows:
        inw = F.col(date_col).between(F.lit(w.begin), F.lit(w.end))
        for name, g in groups.items():
            tags.append(F.when(inw & F.coalesce(g.predicate, F.lit(False)),
                               F.struct(F.lit(w.label).alias("window"), F.lit(name).alias("grp"))))
    lo = min(w.begin for w in windows)
    hi = max(w.end for w in windows)
    rows = fact.where(F.col(date_col).between(F.lit(lo), F.lit(hi)))
    ex = rows.select("user_id", F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("t")) \
        .select("user_id", "t.window", "t.grp")
    per_user = ex.groupBy("window", "grp", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("window", "grp").agg(F.sum("n").cast("long").alias("n_lines"),
                                                 F.count(F.lit(1)).cast("long").alias("n_users"))


def scalar_showcase(order: DataFrame, begin, end, cap) -> DataFrame:
    """C1-C4, C6-C11 applied to the order lines of one window, one row per line."""
    from ..functions.dates import add_days_floor, add_days_trunc, cap_date, days_between
    from ..functions.mathx import date_closeness, decay, rank_weight, within_tolerance

    rows = order.where(F.col("o_date").between(F.lit(begin), F.lit(end)))
    off = days_between("o_date", F.lit(begin))
    x = F.col("o_sku_num").cast("double")
    return rows.select(
        "user_id", "o_id", "sku_id",
        F.year("o_date").alias("year"), F.month("o_date").alias("month"), F.dayofmonth("o_date").alias("day"),
        off.alias("offset"),
        add_days_trunc(begin, x / 7 + F.lit(0.49) - F.lit(1)).alias("date_trunc"),
        add_days_floor(begin, x / 7).alias("date_floor"),
        cap_date(F.col("o_date"), cap).alias("date_capped"),
        F.round(decay(F.when(F.col("o_area") > 2, x), 12.5), 8).alias("decay"),
        F.round(rank_weight(F.col("o_sku_num") + 1), 8).alias("weight"),
        F.round(date_closeness(off - 14), 8).alias("closeness"),
        within_tolerance(x, F.lit(25.0), 0.2, 1.0).alias("close"),
        (x / 4).cast("int").alias("quarter_trunc"),
    )
