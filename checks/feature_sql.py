"""Naive SQL for per-user window features: one filtered GROUP BY per feature.

This mirrors how the reference computes features (filter to window and
group, group by user, left-join onto the users), so it is an independent
check of the single-scan Spark plan.
"""

from __future__ import annotations

from .feature_list import Feature, Window
from .sql_common import d

ROUND = 6  # decimal places of every DOUBLE result, on both sides of the check

PRED_SQL = {
    "all": "TRUE",
    "30": "cate = 30",
    "101": "cate = 101",
    "30_101": "cate IN (30, 101)",
    "others": "(cate IS DISTINCT FROM 30 AND cate IS DISTINCT FROM 101)",
    "30_101_rated": "cate IN (30, 101) AND score_level > 0",
    "30_101_good": "cate IN (30, 101) AND score_level = 1",
}


def feature_sql(ctes: str, fact: str, date_col: str, specs: list[Feature], windows: tuple[Window, ...],
                double_cols: set[str], anchor: str = "users", anchor_cols: str = "u.user_id") -> str:
    wins = {w.label: w for w in windows}
    parts = []
    sel = [anchor_cols]
    for i, s in enumerate(specs):
        w = wins[s.win]
        cond = f"{date_col} BETWEEN {d(w.begin)} AND {d(w.end)} AND {PRED_SQL[s.where]}"
        alias = f"f{i}"
        if s.kind == "rows" or (s.kind == "count" and not s.col):
            agg = "CAST(count(*) AS BIGINT)"
        elif s.kind == "count":
            agg = f"CAST(count({s.col}) AS BIGINT)"
        elif s.kind == "sum":
            t = "DOUBLE" if s.col in double_cols else "BIGINT"
            agg = f"CAST(coalesce(sum({s.col}), 0) AS {t})"
            if t == "DOUBLE":
                agg = f"round({agg}, {ROUND})"
        elif s.kind in ("min", "max"):
            agg = f"{s.kind}({s.col})"
        elif s.kind == "mean":
            agg = f"round(CAST(avg({s.col}) AS DOUBLE), {ROUND})"
        elif s.kind == "nunique":
            agg = f"CAST(count(DISTINCT {s.col}) AS BIGINT)"
        else:
            agg = None
        if agg is not None:
            sub = f"SELECT user_id, {agg} AS v FROM {fact} WHERE {cond} GROUP BY user_id"
        elif s.kind == "mode":
            sub = (f"SELECT user_id, v FROM (SELECT user_id, {s.col} AS v, row_number() OVER "
                   f"(PARTITION BY user_id ORDER BY count(*) DESC, {s.col} ASC) AS rn FROM {fact} "
                   f"WHERE {cond} AND {s.col} IS NOT NULL GROUP BY user_id, {s.col}) WHERE rn = 1")
        elif s.kind in ("gap_mean", "gap_std"):
            lagged = (f"SELECT user_id, {date_col} AS dd, date_diff('day', lag({date_col}) OVER "
                      f"(PARTITION BY user_id ORDER BY {date_col}), {date_col}) AS g FROM {fact} WHERE {cond}")
            if s.kind == "gap_mean":
                sub = f"SELECT user_id, CAST(floor(avg(g)) AS BIGINT) AS v FROM ({lagged}) GROUP BY user_id"
            else:
                sub = (f"SELECT user_id, CASE WHEN count(DISTINCT dd) > 2 THEN round(stddev_samp(g), {ROUND}) END AS v "
                       f"FROM ({lagged}) GROUP BY user_id")
        else:
            raise ValueError(s.kind)
        parts.append(f"LEFT JOIN ({sub}) {alias} ON u.user_id = {alias}.user_id")
        sel.append(f"{alias}.v AS \"{s.name}\"")
    return ctes + "SELECT " + ",\n  ".join(sel) + f"\nFROM {anchor} u\n" + "\n".join(parts)
