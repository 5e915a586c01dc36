"""Regularity weight, submissions, scoring and graph operators (FIXTURES §2)."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from shoprank.operators import graph, ranking, scoring


def test_regularity_weight(spark):
    df = spark.createDataFrame([(1, None, None, 0.0)], "user_id long, OM1_o_date_cate_30_101_gap_var double, "
                               "OM3_o_date_cate_30_101_gap_var double, OM6_o_date_cate_30_101_gap_var double")
    w = df.select(ranking.regularity_weight(df).alias("w")).first()["w"]
    assert abs(w - 1 / 6) < 1e-12


def test_submission_cap_and_ties(spark):
    pred = spark.createDataFrame([(2, 5.0, 30.0), (1, 5.0, 3.0), (3, 9.0, 1.0)],
                                 "user_id long, Label_30_101_BuyNum double, Label_30_101_FirstTime double")
    out = ranking.submission_baseline(pred, date(2017, 5, 1), date(2017, 5, 14), n=10).orderBy("rank").collect()
    assert [r["user_id"] for r in out] == [3, 1, 2]
    assert out[0]["pred_date"] == date(2017, 5, 1)   # int(1 + 0.49 - 1) = 0
    assert out[1]["pred_date"] == date(2017, 5, 3)
    assert out[2]["pred_date"] == date(2017, 5, 14)  # capped


def test_score_perfect_and_hand(spark):
    d0 = date(2017, 5, 3)
    truth = spark.createDataFrame([(1, d0), (2, d0)], "user_id long, order_date date")
    perfect = spark.createDataFrame([(1, d0, 1), (2, d0, 2)], "user_id long, pred_date date, rank long")
    r = scoring.score(truth, perfect).first()
    assert abs(r["s1"] - 1) < 1e-12 and abs(r["s2"] - 1) < 1e-12 and abs(r["s"] - 1) < 1e-12
    pred = spark.createDataFrame([(1, date(2017, 5, 4), 1), (9, d0, 2)], "user_id long, pred_date date, rank long")
    r = scoring.score(truth, pred).first()
    assert abs(r["s1"] - 1 / (1 + 1 / (1 + math.log(2)))) < 1e-12
    assert abs(r["s2"] - (10 / 11) / 2) < 1e-12


def _pr(spark, edges, **kw):
    df = spark.createDataFrame(edges, "src long, dst long")
    return {r["id"]: r["rank"] for r in graph.pagerank(df, **kw).collect()}


def test_pagerank_cycle(spark):
    r = _pr(spark, [(1, 2), (2, 3), (3, 1)])
    assert all(abs(v - 1 / 3) < 1e-9 for v in r.values())


def test_pagerank_dangling_and_node_sets(spark):
    r = _pr(spark, [(1, 2)])
    assert abs(sum(r.values()) - 1) < 1e-9 and r[2] > r[1]
    df = spark.createDataFrame([(1, 2)], "src long, dst long")
    assert [x["id"] for x in graph.dead_ends(df).collect()] == [2]
    assert [x["id"] for x in graph.dead_starts(df).collect()] == [1]


def test_pagerank_self_loop_is_dangling(spark):
    r = _pr(spark, [(1, 1), (2, 1)])
    assert abs(sum(r.values()) - 1) < 1e-9


def test_pagerank_parallel_edges(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "src long, dst long")
    r = {x["id"]: x["rank"] for x in graph.pagerank(df, rtol=None, max_iter=1).collect()}
    n, p = 3, 0.85
    # one update from 1/3: node 1's mass splits 2/3 : 1/3; nodes 2 and 3 are dangling (mass 2/3 spread)
    base = p * (2 / 3) / n + (1 - p) / n
    assert abs(r[2] - (base + p * (1 / 3) * 2 / 3)) < 1e-12
    assert abs(r[3] - (base + p * (1 / 3) * 1 / 3)) < 1e-12


def test_degree_summary_and_counts(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (3, 3)], "src long, dst long")
    c = graph.graph_counts(df).first()
    assert (c["n_edges"], c["n_sources"], c["n_targets"], c["n_nodes"]) == (4, 3, 2, 3)
    s = {r["kind"]: r for r in graph.degree_summary(df).collect()}
    assert s["out"]["count"] == 3 and s["out"]["max"] == 2 and abs(s["out"]["p50"] - 1.0) < 1e-12
    assert s["in"]["count"] == 2 and s["in"]["max"] == 3


def test_pagerank_salted_hub_matches_unsalted(spark):
    import random
    rnd = random.Random(3)
    edges = [(0, rnd.randint(1, 60)) for _ in range(300)] + [(rnd.randint(1, 60), rnd.randint(0, 60)) for _ in range(200)]
    df = spark.createDataFrame(edges, "src long, dst long")
    a = {r["id"]: r["rank"] for r in graph.pagerank(df, rtol=None, max_iter=5).collect()}
    b = {r["id"]: r["rank"] for r in graph.pagerank(df, rtol=None, max_iter=5, salt_rows=10).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert abs(sum(b.values()) - 1) < 1e-9


def test_score_counts_a_repeated_truth_user_once_in_s1(spark):
    d0 = date(2017, 5, 3)
    truth = spark.createDataFrame([(1, d0), (1, d0), (2, d0)], "user_id long, order_date date")
    pred = spark.createDataFrame([(1, d0, 1), (9, d0, 2)], "user_id long, pred_date date, rank long")
    r = scoring.score(truth, pred).first()
    assert abs(r["s1"] - 1 / (1 + 1 / (1 + math.log(2)))) < 1e-12  # membership: 0.629
    assert abs(r["s2"] - 2 / 3) < 1e-12  # every truth row is a hit or a miss of its own
    assert scoring.score(truth.limit(0), pred).first()["s"] == 0 and scoring.score(truth, pred.limit(0)).first()["s"] == 0


def test_pagerank_raises_without_convergence(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3)], "src long, dst long")
    with pytest.raises(RuntimeError, match="not within tolerance"):
        graph.pagerank(df, max_iter=1)
    assert graph.pagerank(df.limit(0)).count() == 0


def test_pagerank_leaves_only_its_result(spark):
    import os

    from shoprank.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = spark.createDataFrame([(i % 40, (i * 7) % 41) for i in range(400)], "src long, dst long")
    graph.pagerank(df, partitions=4).count()
    left = set(os.listdir(folder)) - before
    assert len([x for x in left if x.startswith("pagerank-")]) == 1


def test_graph_profile_has_every_degree(spark):
    df = spark.createDataFrame([(1, i) for i in range(2, 60)], "src long, dst long")
    rows = {(r["section"], r["kind"], r["key"]): r["value"] for r in graph.graph_profile(df).collect()}
    assert rows["histogram", "out", "58"] == 1 and rows["histogram", "in", "1"] == 58 and rows["counts", "all", "n_edges"] == 58


def test_private_folder_only_for_a_local_master():
    from shoprank.session import private_folder

    assert private_folder("local[4]")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            private_folder(master)


def test_edge_join_tasks_follow_the_lines_and_nodes_take_one_pass(spark, monkeypatch):
    from shoprank.sources import edges as source

    few = source.edges_from_testdata(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(source, "LINES_A_TASK", 50)
    e = source.edges_from_testdata(spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in e._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, e.collect())) == sorted(map(tuple, few.collect()))
    nodes = graph.all_nodes(e)
    assert nodes._jdf.queryExecution().executedPlan().toString().count("Join") == 1
    want = {x for r in few.collect() for x in r}
    assert sorted(r[0] for r in nodes.collect()) == sorted(want)
    odd = spark.createDataFrame([(1, None), (None, 2), (1, 2)], "src long, dst long")
    assert {r[0] for r in graph.all_nodes(odd).collect()} == {1, 2, None}
