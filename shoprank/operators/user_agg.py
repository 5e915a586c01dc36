"""Per-user conditional aggregation over several date windows at two grains.

This is the engine behind every feature and label builder. A feature is an
aggregate (count, sum, min, max, mean, distinct count, mode, mean gap, gap
deviation) of one column over the rows of one user that fall in one date
window and satisfy one predicate (a category group, a score filter, ...).
The reference computes each feature with its own filter-group-merge round;
here each feature belongs to one of two aggregates over the same narrow rows.

Date grain — ``groupBy(user, date)``. Window membership is a function of the
  date, so at this grain row counts, sums, minima and maxima per predicate do
  not depend on the window. ``groupBy(user)`` then adds up the dates of every
  window; distinct dates, months and days are read off the same rows as
  counts and bit sets. Gap deviation needs successive dates: the date before,
  per predicate, comes from a window over the user's date rows (one row per
  day of the window hull at most, a bound set by the window length and not by
  the data volume), and the squares of the gaps are summed. Repeated dates
  are zero gaps, so with n rows, first and last date and that sum the sample
  deviation follows exactly.

Key grain — ``groupBy(user, column, value)`` for columns that need a distinct
  count or a mode. A row becomes one (column, value) entry per such column
  that carries nothing but a bit mask of the (predicate, window) pairs the row
  belongs to. Masks are or-ed per value, modes count rows per pair, and
  ``groupBy(user)`` turns them into distinct counts (no per-expression
  ``Expand``) and modes, the largest of ``count * 2^64 - value``.

All four aggregates keep plain numbers only, so they run as hash aggregates
with map-side combine and generated code, and each is small enough to be
compiled. A heavy user's rows spread over many reducers at the first level
because date or value is part of the key.

Guards (N15): a count, distinct count or sum is NULL when the user has no
row in the window and predicate, as in the reference where such a user is
absent from the grouped frame; a sum over present rows with NULL values is 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.windows import Win

EPOCH = date(1970, 1, 1)
_TWO63, _TWO64 = (f"CAST({1 << n} AS DECIMAL(20,0))" for n in (63, 64))
INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
KINDS = {"rows", "count", "sum", "min", "max", "mean", "nunique", "mode", "gap_mean", "gap_std"}


@dataclass(frozen=True)
class Agg:
    """One output column: ``kind`` of ``col`` over rows of window ``win`` matching ``where``."""

    name: str
    kind: str
    col: str | None = None
    where: str = "all"
    win: str = ""


def _epoch_days(d: date) -> int:
    return (d - EPOCH).days


def user_window_agg(
    fact: DataFrame,
    specs: list[Agg],
    windows: list[Win] | tuple[Win, ...],
    preds: dict[str, Column],
    date_col: str,
    key: str = "user_id",
    date_parts: dict[str, str] | None = None,
) -> DataFrame:
    """Compute ``specs`` per ``key``; returns ``key`` plus one column per spec.

    ``date_parts`` declares columns that are a part of ``date_col``
    (``{"o_month": "month", "o_day": "day"}``); their distinct counts are
    read off the date rows as a bit set of month or day numbers.

    ``preds`` maps predicate names used in ``Agg.where`` to row predicates on
    ``fact`` (``"all"`` is implicit). Only users with at least one row in the
    hull of the windows appear; anchor the result on a user table with a left
    join to get one row per user.
    """
    wins = {w.label: w for w in windows}
    preds = {"all": F.lit(True), **preds}
    fact_types = {f.name: f.dataType.simpleString() for f in fact.schema.fields}
    for s in specs:
        if s.kind not in KINDS:
            raise ValueError(f"unknown aggregate kind {s.kind}")
        if s.win not in wins:
            raise ValueError(f"unknown window {s.win!r} in {s.name}")
        if s.where not in preds:
            raise ValueError(f"unknown predicate {s.where!r} in {s.name}")
        if s.kind in ("mode", "nunique") and s.col != date_col and fact_types.get(s.col) not in INTEGRAL:
            raise ValueError(f"{s.kind} of {s.col} needs an integral column (it keys level-1 rows)")
    lo = min(w.begin for w in windows)
    hi = max(w.end for w in windows)
    wb = {w.label: (_epoch_days(w.begin), _epoch_days(w.end)) for w in windows}

    pred_names = sorted({s.where for s in specs})
    pidx = {p: i for i, p in enumerate(pred_names)}
    win_names = sorted(wins)
    widx = {w: i for i, w in enumerate(win_names)}

    parts = {c: p for c, p in (date_parts or {}).items() if p in ("month", "day")}
    keyed = [s for s in specs if s.kind == "mode" or (s.kind == "nunique" and s.col != date_col and s.col not in parts)]
    if any(s.kind == "mode" and s.col == date_col for s in specs):
        raise ValueError("mode of the window date column is not supported")
    tag_of = {c: i + 1 for i, c in enumerate(dict.fromkeys(s.col for s in keyed))}
    bit_of = {pair: i for i, pair in enumerate(dict.fromkeys((s.where, s.win) for s in keyed))}
    if len(bit_of) > 62:
        raise ValueError("too many (predicate, window) pairs of distinct counts and modes")
    value_cols = sorted({s.col for s in specs if s.col and s.col != date_col})

    # The expressions are written as SQL text: one JVM call per expression
    # keeps plan construction cheap for a hundred features.
    def P(name: str) -> str:
        return f"_p{pidx[name]}"

    def V(c: str) -> str:
        return "_d" if c == date_col else f"`_v_{c}`"

    # ---- rows: key, day number, predicates and values
    sel = [F.col(key).alias("_u"), F.unix_date(F.col(date_col)).alias("_d")]
    sel += [F.coalesce(preds[p], F.lit(False)).alias(f"_p{pidx[p]}") for p in pred_names]
    sel += [F.col(c).alias(f"_v_{c}") for c in value_cols]
    rows = fact.where(F.col(date_col).between(F.lit(lo), F.lit(hi))).select(sel).where(F.col("_u").isNotNull())

    # ---- date grain, first level: measures per predicate, whatever the window
    m1: dict[str, str] = {}
    for sp in specs:
        w, c = sp.where, sp.col
        m1.setdefault(f"r_{pidx[w]}", f"sum(CASE WHEN {P(w)} THEN 1 END)")
        if sp.kind in ("count", "mean") and c:
            m1.setdefault(f"c_{pidx[w]}_{c}", f"sum(CASE WHEN {P(w)} AND {V(c)} IS NOT NULL THEN 1 END)")
        if sp.kind in ("sum", "mean"):
            m1.setdefault(f"s_{pidx[w]}_{c}", f"sum(CASE WHEN {P(w)} THEN {V(c)} END)")
        if sp.kind in ("min", "max"):
            m1.setdefault(f"{sp.kind}_{pidx[w]}_{c}", f"{sp.kind}(CASE WHEN {P(w)} THEN {V(c)} END)")
    days = rows.groupBy("_u", "_d").agg(*[F.expr(e).alias(n) for n, e in m1.items()])
    gap_preds = sorted({pidx[s.where] for s in specs if s.kind == "gap_std"})
    if gap_preds:
        before = "OVER (PARTITION BY _u ORDER BY _d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        days = days.selectExpr("*", *[f"last_value(CASE WHEN r_{p} > 0 THEN _d END) IGNORE NULLS {before} AS b_{p}" for p in gap_preds])

    # ---- key grain, first level: masks and counts per value
    if keyed:
        mask = " | ".join(f"(CASE WHEN {P(w)} AND _d BETWEEN {wb[x][0]} AND {wb[x][1]} THEN {1 << i}L ELSE 0L END)" for (w, x), i in bit_of.items())
        entries = ", ".join(f"struct({t} AS t, CAST({V(c)} AS BIGINT) AS kv)" for c, t in tag_of.items())
        narrow = rows.selectExpr("_u", f"({mask}) AS _m", *[V(c) for c in tag_of]).where("_m <> 0")
        narrow = narrow.selectExpr("_u", "_m", f"explode(array({entries})) AS _e").selectExpr("_u", "_m", "_e.t AS t", "_e.kv AS kv").where("kv IS NOT NULL")
        slots = dict.fromkeys(bit_of[s.where, s.win] for s in keyed if s.kind == "mode")
        modes = " OR ".join(f"t = {t}" for t in dict.fromkeys(tag_of[s.col] for s in keyed if s.kind == "mode"))
        k1 = {"mask": "bit_or(_m)"} | {f"n_{i}": f"sum(CASE WHEN ({modes}) AND _m & {1 << i}L <> 0 THEN 1 ELSE 0 END)" for i in slots}
        values = narrow.groupBy("_u", "t", "kv").agg(*[F.expr(e).alias(n) for n, e in k1.items()])

    # ---- second level: per user
    d2: dict[str, str] = {}
    k2: dict[str, str] = {}

    def need(level: dict[str, str], name: str, expr: str) -> str:
        level.setdefault(name, expr)
        return f"`{name}`"

    def in_win(win: str) -> str:
        return f"_d BETWEEN {wb[win][0]} AND {wb[win][1]}"

    out: list[str] = []
    for sp in specs:
        p, c, win = pidx[sp.where], sp.col, in_win(sp.win)
        k = f"{p}_{widx[sp.win]}"
        n = need(d2, f"R_{k}", f"sum(CASE WHEN {win} THEN r_{p} END)")
        g = f"{n} > 0"
        present = f"{win} AND r_{p} > 0"
        if sp.kind == "rows" or (sp.kind == "count" and not c):
            val = f"CAST(CASE WHEN {g} THEN {n} END AS BIGINT)"
        elif sp.kind == "count":
            cc = need(d2, f"C_{k}_{c}", f"sum(CASE WHEN {win} THEN `c_{p}_{c}` END)")
            val = f"CAST(CASE WHEN {g} THEN coalesce({cc}, 0) END AS BIGINT)"
        elif sp.kind == "sum":
            sm = need(d2, f"S_{k}_{c}", f"sum(CASE WHEN {win} THEN `s_{p}_{c}` END)")
            val = f"CASE WHEN {g} THEN coalesce({sm}, 0) END"
        elif sp.kind == "mean":
            sm = need(d2, f"S_{k}_{c}", f"sum(CASE WHEN {win} THEN `s_{p}_{c}` END)")
            cc = need(d2, f"C_{k}_{c}", f"sum(CASE WHEN {win} THEN `c_{p}_{c}` END)")
            val = f"CAST({sm} AS DOUBLE) / CASE WHEN {cc} > 0 THEN {cc} END"
        elif sp.kind in ("min", "max"):
            val = need(d2, f"{sp.kind}_{k}_{c}", f"{sp.kind}(CASE WHEN {win} THEN `{sp.kind}_{p}_{c}` END)")
        elif sp.kind == "nunique" and c in parts:
            fn = "month" if parts[c] == "month" else "dayofmonth"
            seen = need(d2, f"BP_{k}_{c}", f"bit_or(CASE WHEN {present} THEN shiftleft(1L, {fn}(date_from_unix_date(_d))) END)")
            val = f"CAST(CASE WHEN {g} THEN coalesce(bit_count({seen}), 0) END AS BIGINT)"
        elif sp.kind == "nunique" and c == date_col:
            nd = need(d2, f"ND_{k}", f"count(CASE WHEN {present} THEN 1 END)")
            val = f"CAST(CASE WHEN {g} THEN {nd} END AS BIGINT)"
        elif sp.kind == "nunique":
            nu = need(k2, f"NU_{k}_{c}", f"count(CASE WHEN t = {tag_of[c]} AND mask & {1 << bit_of[sp.where, sp.win]}L <> 0 THEN 1 END)")
            val = f"CAST(CASE WHEN {g} THEN coalesce({nu}, 0) END AS BIGINT)"
        elif sp.kind == "mode":
            # the largest count, then the smallest value, as one number
            slot = f"n_{bit_of[sp.where, sp.win]}"
            top = need(k2, f"MO_{k}_{c}", f"max(CASE WHEN t = {tag_of[c]} AND {slot} > 0 THEN CAST({slot} AS DECIMAL(18,0)) * {_TWO64} - kv END)")
            val = f"CAST({_TWO63} - ({top} + {_TWO63}) % {_TWO64} AS {fact_types[c]})"
        else:
            first = need(d2, f"DMN_{k}", f"min(CASE WHEN {present} THEN _d END)")
            last = need(d2, f"DMX_{k}", f"max(CASE WHEN {present} THEN _d END)")
            if sp.kind == "gap_mean":
                val = f"CAST(CASE WHEN {n} > 1 THEN floor(({last} - {first}) / ({n} - 1)) END AS BIGINT)"
            else:  # gap_std
                nd = need(d2, f"ND_{k}", f"count(CASE WHEN {present} THEN 1 END)")
                gap = f"CAST(_d - b_{p} AS BIGINT)"
                ss = need(d2, f"SS_{k}", f"sum(CASE WHEN {present} AND b_{p} >= {wb[sp.win][0]} THEN {gap} * {gap} END)")
                m, span = f"CAST({n} - 1 AS DOUBLE)", f"CAST({last} - {first} AS DOUBLE)"
                var = f"((CAST({ss} AS DOUBLE) - {span} * {span} / {m}) / ({m} - 1))"
                val = f"CASE WHEN {nd} > 2 THEN sqrt(greatest({var}, 0.0)) END"
        out.append(f"{val} AS `{sp.name}`")

    users = days.groupBy("_u").agg(*[F.expr(e).alias(n) for n, e in d2.items()])
    if keyed:
        users = users.join(values.groupBy("_u").agg(*[F.expr(e).alias(n) for n, e in k2.items()]), "_u", "left")
    return users.selectExpr(f"_u AS `{key}`", *out)
