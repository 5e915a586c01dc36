"""Enrichment, banding, prototype score attach and the action-to-order gap."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from shoprank.operators import enrich, pairs
from shoprank.plans.windows import Win
from shoprank.schema import RetailBundle


def test_quintile_edges_and_bands(spark):
    df = spark.createDataFrame([(float(x),) for x in (10, 11, 12, 13, 14, 15, 20)], "price double")
    edges = df.select(enrich.quintile_edges(df, ["price"])["price"].alias("e")).first()["e"]
    assert [round(x, 6) for x in edges] == [10, 11.2, 12.4, 13.6, 14.8, 20]
    small = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 8, 9, 20, 30, 3, 4, 6)], "v double")
    e2 = small.select(enrich.quintile_edges(small, ["v"])["v"].alias("e")).first()["e"]
    assert [round(x, 6) for x in e2] == [0, 1.8, 3.6, 6.8, 11.2, 30]
    bands = {r["v"]: r["b"] for r in small.select("v", enrich.quintile_band(F.col("v"), enrich.quintile_edges(small, ["v"])["v"]).alias("b")).collect()}
    # computed from original values; an inner edge belongs to the lower band
    assert bands[0.0] == 0 and bands[1.0] == 0 and bands[2.0] == 1 and bands[30.0] == 4 and bands[8.0] == 3


def _bundle(spark, orders, comments):
    empty_users = spark.createDataFrame([(1, 1, 1, 1)], "user_id long, age int, sex int, user_lv_cd int")
    skus = spark.createDataFrame([(5, 2.0, 30, 1, 1, -1)], "sku_id long, price double, cate int, para_1 int, para_2 int, para_3 int")
    o = spark.createDataFrame(orders, "user_id long, sku_id long, o_id long, o_date date, o_area int, o_sku_num int")
    c = spark.createDataFrame(comments, "user_id long, comment_create_tm timestamp_ntz, o_id long, score_level int")
    a = spark.createDataFrame([], "user_id long, sku_id long, a_date date, a_num int, a_type int")
    return RetailBundle(user=empty_users, sku=skus, action=a, order=o, comment=c)


def test_two_comments_fan_out(spark):
    from datetime import datetime
    b = _bundle(spark, [(1, 5, 100, date(2001, 1, 1), 1, 3)],
                [(1, datetime(2001, 1, 2), 100, 1), (1, datetime(2001, 1, 3), 100, 3)])
    rows = enrich.enrich_orders(b).collect()
    assert len(rows) == 2 and {r["total_price"] for r in rows} == {6.0}


def test_same_day_repeat_weight(spark):
    from datetime import datetime
    d = date(2001, 1, 1)
    b = _bundle(spark, [(1, 5, 100, d, 1, 1), (1, 5, 101, d, 1, 1)],
                [(1, datetime(2001, 1, 2), 100, 1), (1, datetime(2001, 1, 2), 101, 1)])
    rows = enrich.prototype_order_scores(b.order, b.comment).collect()
    assert len(rows) == 1 and rows[0]["weight"] == 4 and rows[0]["score_level"] == 1


def _brute(actions, orders, win, strict):
    per = {}
    for (u, s, ad) in actions:
        for (u2, s2, od) in orders:
            if u == u2 and s == s2 and (od > ad if strict else od >= ad) and win.begin <= ad <= win.end and win.begin <= od <= win.end:
                per.setdefault(u, []).append((od - ad).days)
    return {u: sum(v) / len(v) for u, v in per.items()}


def test_action_order_gap_matches_pairs(spark):
    rnd = random.Random(7)
    base = date(2001, 1, 1)
    acts = [(rnd.randint(1, 4), rnd.randint(1, 3), base + timedelta(days=rnd.randint(0, 40))) for _ in range(200)]
    ords = [(rnd.randint(1, 4), rnd.randint(1, 3), base + timedelta(days=rnd.randint(0, 40))) for _ in range(120)]
    wins = (Win("1", date(2001, 1, 20), date(2001, 2, 10)), Win("3", date(2001, 1, 1), date(2001, 2, 10)))
    a = spark.createDataFrame(acts, "user_id long, sku_id long, a_date date")
    o = spark.createDataFrame(ords, "user_id long, sku_id long, o_date date")
    for strict in (False, True):
        got = pairs.action_order_gap(a, o, wins, {"1": "g1", "3": "g3"}, strict).collect()
        got = {r["user_id"]: (r["g1"], r["g3"]) for r in got}
        for i, w in enumerate(wins):
            want = _brute(acts, ords, w, strict)
            for u, (g1, g3) in got.items():
                val = (g1, g3)[i]
                if u in want:
                    assert abs(val - want[u]) < 1e-9
                else:
                    assert val is None


def test_same_day_pair_kept_only_when_not_strict(spark):
    d = date(2001, 1, 5)
    w = (Win("1", date(2001, 1, 1), date(2001, 1, 31)),)
    a = spark.createDataFrame([(1, 1, d)], "user_id long, sku_id long, a_date date")
    o = spark.createDataFrame([(1, 1, d)], "user_id long, sku_id long, o_date date")
    assert pairs.action_order_gap(a, o, w, {"1": "g"}, strict=False).first()["g"] == 0.0
    assert pairs.action_order_gap(a, o, w, {"1": "g"}, strict=True).first()["g"] is None


def test_quintile_edges_match_linear_quantiles(spark):
    import numpy as np

    rnd = random.Random(11)
    vals = [float(rnd.choice([rnd.randint(0, 30), rnd.uniform(0, 100)])) for _ in range(137)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    edges = df.select(enrich.quintile_edges(df, ["v"])["v"].alias("e")).first()["e"]
    want = np.quantile(np.array(vals), [0, 0.2, 0.4, 0.6, 0.8, 1.0])
    assert np.allclose(edges, want, rtol=0, atol=1e-9)
    got = {r["v"]: r["b"] for r in df.select("v", enrich.quintile_band(F.col("v"), enrich.quintile_edges(df, ["v"])["v"]).alias("b")).collect()}
    for v in vals:
        assert got[v] == next(i for i in range(5) if v <= want[i + 1] or i == 4)
