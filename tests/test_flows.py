"""End-to-end flows on the smallest tables (few boosting rounds)."""

import os
import tempfile
from datetime import date

from pyspark.sql import functions as F

from shoprank.plans import catalog as C
from shoprank.plans import flows
from shoprank.sources import edges as E
from shoprank.sources import retail

SF = "/root/testdata/sf0.001"


def test_baseline_and_refactored_flows(spark):
    b = retail.retail_from_testdata(spark, SF)
    ps = retail.pair_sources_from_testdata(spark, SF)
    out = os.path.join(tempfile.mkdtemp(prefix="shoprank-flow-"), "sub")
    sub = flows.run_baseline(b, date(2001, 2, 1), date(2001, 2, 14), n=50, action_windows=C.ACTION_WINDOWS,
                             pair_sources=ps, out=out, rounds=3)
    rows = sub.collect()
    assert 0 < len(rows) <= 50 and all(r["pred_date"] <= date(2001, 2, 14) for r in rows)
    assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))
    assert any(fn.endswith(".txt") for fn in os.listdir(out))
    score = flows.run_refactored(b, date(2001, 2, 1), validation=True, n=50, action_windows=C.ACTION_WINDOWS,
                                 pair_sources=ps, rounds=3).first()
    assert 0.0 <= score["s"] <= 1.0


def test_prototype_flow(spark):
    b = retail.retail_from_testdata(spark, SF)
    sub = flows.run_prototype(b, [date(2000, 11, 1), date(2000, 12, 1), date(2001, 1, 1)], date(2001, 2, 1),
                              cate_types=("tg",), n=100, num_trees=3)
    rows = sub.collect()
    assert {"user_id", "pred_date"} <= set(sub.columns) and len({r["user_id"] for r in rows}) == len(rows)
    assert all(r["pred_date"] <= date(2001, 2, 14) for r in rows)


def test_pagerank_flow(spark):
    d = tempfile.mkdtemp(prefix="shoprank-prflow-")
    ranks, top = flows.run_pagerank(E.edges_from_testdata(spark, SF), os.path.join(d, "ranks"), os.path.join(d, "top"),
                                    top_n=10, max_iter=5, rtol=None)
    assert top.count() == 10
    assert abs(spark.read.parquet(os.path.join(d, "ranks")).agg(F.sum("rank")).first()[0] - 1.0) < 1e-9
