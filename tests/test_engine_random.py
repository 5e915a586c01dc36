"""Randomised check of the single-scan engine against a per-feature pandas model.

The model follows the reference's way of computing each feature: filter the
rows to the window and group, group by user, aggregate, left-join onto the
users. Data are drawn with unknown categories, NULL values, repeated days,
multi-line orders and window-edge dates.
"""

import math
import random
from datetime import date, timedelta

import pandas as pd
import pytest

from shoprank.operators import features
from shoprank.operators.user_agg import user_window_agg
from shoprank.plans.windows import feature_windows

WINS = feature_windows(date(2001, 2, 1)).features
CATES = [30, 101, 71, None]
PRED = {
    "all": lambda d: pd.Series(True, index=d.index),
    "30": lambda d: d.cate == 30,
    "101": lambda d: d.cate == 101,
    "30_101": lambda d: d.cate.isin([30, 101]),
    "others": lambda d: ~d.cate.isin([30, 101]),
    "30_101_rated": lambda d: d.cate.isin([30, 101]) & (d.score_level > 0),
    "30_101_good": lambda d: d.cate.isin([30, 101]) & (d.score_level == 1),
}


def _data(seed):
    rnd = random.Random(seed)
    rows = []
    oid = 0
    for _ in range(rnd.randint(40, 90)):
        oid += 1
        u = rnd.randint(1, 7)
        d = date(2000, 7, 25) + timedelta(days=rnd.randint(0, 200))
        if rnd.random() < 0.1:
            d = rnd.choice([w.begin for w in WINS] + [WINS[0].end])
        for _ in range(rnd.randint(1, 3)):
            cate = rnd.choice(CATES)
            price = None if rnd.random() < 0.1 else round(rnd.uniform(1, 50), 2)
            qty = rnd.randint(1, 4)
            rows.append(dict(user_id=u, sku_id=rnd.randint(1, 12), o_id=oid, o_date=d, o_area=rnd.randint(1, 3),
                             o_sku_num=qty, cate=cate, score_level=rnd.choice([-1, 1, 3]),
                             o_month=d.month, o_day=d.day,
                             o_total_price=None if price is None else price * qty))
    return rows


def _model(pdf, specs):
    out = {}
    wins = {w.label: w for w in WINS}
    for s in specs:
        w = wins[s.win]
        sub = pdf[(pdf.o_date >= w.begin) & (pdf.o_date <= w.end)]
        sub = sub[PRED[s.where](sub).fillna(False).astype(bool)]
        res = {}
        for u, g in sub.groupby("user_id"):
            if s.kind == "rows":
                v = len(g)
            elif s.kind == "count":
                v = int(g[s.col].notna().sum())
            elif s.kind == "sum":
                v = float(g[s.col].fillna(0).sum())
            elif s.kind == "nunique":
                v = int(g[s.col].nunique())
            elif s.kind == "min":
                v = g[s.col].min()
            elif s.kind == "max":
                v = g[s.col].max()
            elif s.kind == "mean":
                v = g[s.col].mean()
            elif s.kind == "mode":
                vc = g[s.col].dropna().value_counts()
                v = min(vc[vc == vc.max()].index) if len(vc) else None
            elif s.kind == "gap_mean":
                ds = sorted(g.o_date)
                gaps = [(b - a).days for a, b in zip(ds, ds[1:])]
                v = math.floor(sum(gaps) / len(gaps)) if gaps else None
            elif s.kind == "gap_std":
                ds = sorted(g.o_date)
                gaps = [(b - a).days for a, b in zip(ds, ds[1:])]
                v = pd.Series(gaps, dtype=float).std() if g.o_date.nunique() > 2 else None
            res[u] = v
        out[s.name] = res
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_engine_matches_per_feature_model(spark, seed):
    rows = _data(seed)
    schema = ("user_id long, sku_id long, o_id long, o_date date, o_area int, o_sku_num int, cate int, "
              "score_level int, o_month int, o_day int, o_total_price double")
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    specs = features.refactored_order_specs(WINS)
    got = {r["user_id"]: r.asDict() for r in features.refactored_order_features(df, WINS).collect()}
    want = _model(pd.DataFrame(rows), specs)
    for s in specs:
        for u in got:
            g = got[u][s.name]
            w = want[s.name].get(u)
            if w is None or (isinstance(w, float) and math.isnan(w)):
                assert g is None, (s.name, u, g, w)
            else:
                assert g is not None and abs(float(g) - float(w)) < 1e-9, (s.name, u, g, w)
