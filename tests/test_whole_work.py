"""Queries over rows of the tests' own: the whole time of a feature, all boosting rounds, whole lists."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoprank.operators import trees
from shoprank.plans import catalog as C
from shoprank.plans import models
from shoprank.sources import retail


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The five tables with 320 users, whose orders begin in July 2000 and go on month by month."""
    d, users = str(tmp_path_factory.mktemp("whole")), range(320)
    days = [(u, k, datetime(2000 + (6 + k) // 12, (6 + k) % 12 + 1, 3 + u % 20)) for u in users for k in range(8) if (u + k) % 3]
    rows = {"customer": [(u, f"c{u}", u % 25, 10.0 * u, ("BUILDING", "MACHINERY")[u % 2]) for u in users],
            "part": [(p, f"p{p}", f"Brand#{p}", ("PROMO", "LARGE", "ECONOMY")[p % 3], p, 1.5 * p) for p in range(30)],
            "orders": [(10 * u + k, u, "FO"[u % 2], 9.0, t, f"{1 + u % 5}-X") for u, k, t in days],
            "lineitem": [(10 * u + k, (u + k) % 30, 0, n, 1.0 + n, 5.0, 0.0, 0.0, "N", "O", datetime(t.year, t.month, t.day + 4))
                         for u, k, t in days for n in range(1 + u % 3)],
            "events": [(u, datetime(2024, 1, 1 + u % 29), u, ("view", "click")[u % 2], float(u), f'{{"k": {u % 30}}}') for u in users]}
    for name, r in rows.items():
        spark.createDataFrame(r, retail.TESTDATA_SCHEMAS[name]).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_training_features_count_the_first_month_of_their_time(spark, tables):
    _, train, test, _ = C._ml_frames(spark, tables)
    for frame, windows in ((train, C.TRAIN_WINDOWS), (test, C.ORDER_WINDOWS)):
        lines = retail.order_lines_from_testdata(spark, tables)
        for w in windows.features:
            want = lines.where(F.col("o_date").between(F.lit(w.begin), F.lit(w.end))).agg(F.countDistinct("o_id")).first()[0]
            assert frame.agg(F.sum(f"{w.label}mo_order_all_num")).first()[0] == want > 0


@pytest.fixture
def asked(monkeypatch):
    """The rounds that a query asks for; it gets one."""
    seen, boost = [], trees.boost
    monkeypatch.setattr(trees, "boost", lambda *a, **kw: seen.append(kw["rounds"]) or boost(*a, **{**kw, "rounds": 1}))
    return seen


@pytest.mark.parametrize("query", ["p_baseline_flow", "p_refactored_flow"])
def test_flows_take_all_rounds_and_list_all_users(spark, tables, asked, query):
    facts = C.QUERIES[query](spark, tables).first()
    assert asked == [models.ROUNDS] == [100]
    assert facts["listed"] == facts["known"] == facts["users"] == 320 and facts["in_time"]


@pytest.mark.parametrize("query", ["x11_prediction_range", "x18_feature_list"])
def test_checked_models_take_all_rounds(spark, tables, asked, query):
    assert C.QUERIES[query](spark, tables).count() and asked == [100]
