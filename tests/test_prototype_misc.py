"""Prototype pipeline, user alignment, successive gaps, group counts, invariants."""

from datetime import date

from pyspark.sql import functions as F

from shoprank.operators import enrich, features, graph, prototype, ranking
from shoprank.plans.windows import Win

SKU = "sku_id long, price int, cate int, para_1 int, para_2 int, para_3 int"


def _skus(spark):
    # recoded categories: 1 -> 30, 2 -> 101, 0 -> other
    return spark.createDataFrame([(1, 0, 1, 0, 0, -1), (2, 0, 2, 0, 0, -1), (3, 0, 0, 0, 0, -1)], SKU)


def test_prototype_features_outer_merge_and_fill(spark):
    actions = spark.createDataFrame(
        [(1, 1, date(2017, 3, 2), 4, 1), (1, 1, date(2017, 3, 3), 2, 2), (2, 3, date(2017, 3, 3), 5, 1),
         (3, 1, date(2017, 3, 3), 7, 3)],
        "user_id long, sku_id long, a_date date, a_num int, a_type int")
    orders = spark.createDataFrame(
        [(1, 2, date(2017, 3, 5), 1, 2), (4, 1, date(2017, 3, 6), 3, 1), (5, 3, date(2017, 3, 6), -1, 1)],
        "user_id long, sku_id long, o_date date, score_level int, weight long")
    out = {r["user_id"]: r.asDict() for r in prototype.prototype_features(
        actions, orders, _skus(spark), date(2017, 3, 1), date(2017, 3, 31), ("30", "tg")).collect()}
    # user 2 only viewed an "other" sku, user 3 only had type-3 actions, user 5 ordered an "other" sku
    assert set(out) == {1, 4}
    assert out[1]["view_num_30"] == 4 and out[1]["star_num_30"] == 2 and out[1]["view_num_tg"] == 4
    assert out[1]["order_num_tg"] == 2 and out[1]["good_score_num_tg"] == 2 and out[1]["order_num_30"] == 0
    assert out[4]["bad_score_num_30"] == 1 and out[4]["view_num_30"] == 0


def test_prototype_labels_and_alignment(spark):
    orders = spark.createDataFrame(
        [(1, 1, date(2017, 4, 3), -1, 1), (1, 2, date(2017, 4, 1), -1, 2), (9, 1, date(2017, 4, 2), -1, 1)],
        "user_id long, sku_id long, o_date date, score_level int, weight long")
    feats = spark.createDataFrame([(1,), (2,)], "user_id long")
    lab = {r["user_id"]: r.asDict() for r in prototype.prototype_labels(
        orders, _skus(spark), date(2017, 4, 1), date(2017, 4, 30), feats, ("30", "101")).collect()}
    assert lab[1] == {"user_id": 1, "pred_date_30": 2, "order_num_30": 1, "pred_date_101": 0, "order_num_101": 2}
    assert lab[2] == {"user_id": 2, "pred_date_30": -1, "order_num_30": -1, "pred_date_101": -1, "order_num_101": -1}
    assert 9 not in lab
    agg = prototype.prototype_label_aggregates(orders, _skus(spark), date(2017, 4, 1), date(2017, 4, 30), ("30", "101"))
    explicit = {r["user_id"]: r.asDict() for r in prototype.align_to_users(agg, feats).collect()}
    assert explicit == lab


def test_prototype_submission_invalidation_and_cap(spark):
    lab = spark.createDataFrame(
        [(1, 20, 2, 3, 1), (2, 0, 5, -1, -1), (3, 4, 0, 6, 1), (4, -1, -1, -1, -1)],
        "user_id long, pred_date_30 long, order_num_30 long, pred_date_101 long, order_num_101 long")
    out = ranking.submission_prototype(lab, date(2017, 5, 1), date(2017, 5, 31), n=10).orderBy("rank").collect()
    # user 2: day 0 < 0.5 -> invalid; user 3: count 0 -> first pair invalid, second valid (day 6)
    assert [(r["user_id"], r["pred_date"]) for r in out] == [(1, date(2017, 5, 4)), (3, date(2017, 5, 7))]


def test_successive_gaps_compact_form(spark):
    df = spark.createDataFrame([(1, date(2017, 1, d)) for d in (1, 1, 4, 9)] + [(2, date(2017, 1, 5))],
                               "user_id long, o_date date")
    rows = {(r["user_id"], r["o_date"].day): (r["n_rows"], r["gap"]) for r in features.successive_gaps(df, "o_date").collect()}
    assert rows == {(1, 1): (2, None), (1, 4): (1, 3), (1, 9): (1, 5), (2, 5): (1, None)}


def test_group_line_counts_null_safe_others(spark):
    w = (Win("1", date(2017, 1, 1), date(2017, 1, 31)),)
    df = spark.createDataFrame([(1, date(2017, 1, 2), 30), (1, date(2017, 1, 3), None), (2, date(2017, 1, 3), 71)],
                               "user_id long, o_date date, cate int")
    got = {(r["grp"]): (r["n_lines"], r["n_users"]) for r in features.group_line_counts(df, w).collect()}
    assert got["others"] == (2, 2) and got["all"] == (3, 2) and got["30_101"] == (1, 1) and "101" not in got


def test_feature_matrix_one_row_per_user(spark):
    from shoprank.plans import catalog as C
    df = C.QUERIES["x5_build_features"](spark, "/root/testdata/sf0.001")
    assert df.count() == df.select("user_id").distinct().count() == df.sparkSession.read.parquet(
        "/root/testdata/sf0.001/customer.parquet").count()


def test_score_and_ranks_are_bounded(spark):
    from shoprank.plans import catalog as C
    r = C.QUERIES["x10_score"](spark, "/root/testdata/sf0.001").first()
    assert all(0.0 <= r[k] <= 1.0 for k in ("s1", "s2", "s"))
    pr = graph.pagerank(C._edges(spark, "/root/testdata/sf0.001"))  # the query itself rounds to 6 places
    assert abs(pr.agg(F.sum("rank")).first()[0] - 1.0) < 1e-9


def test_floored_day_difference(spark):
    from datetime import datetime

    from shoprank.functions.dates import floor_days_between_ts
    df = spark.createDataFrame([(datetime(2017, 5, 1, 12, 0), datetime(2017, 5, 3, 0, 0))],
                               "p timestamp_ntz, t timestamp_ntz")
    assert df.select(floor_days_between_ts("p", "t").alias("d")).first()["d"] == -2


def test_user_without_orders_has_null_features_and_zero_labels(spark):
    from shoprank.operators import enrich, labels
    from shoprank.plans import catalog as C
    from shoprank.sources import retail
    b = retail.retail_from_testdata(spark, "/root/testdata/sf0.001")
    extra = spark.createDataFrame([(10 ** 9, 1, 1, 1)], "user_id long, age int, sex int, user_lv_cd int")
    users = b.user.unionByName(extra)
    of = enrich.order_fact(b)
    f = features.anchor(users.select("user_id"), features.refactored_order_features(of, C.ORDER_WINDOWS.features))
    row = f.where(F.col("user_id") == 10 ** 9).first().asDict()
    assert all(v is None for k, v in row.items() if k != "user_id")
    lab = labels.build_labels(users, of, C.LABEL.label_begin, C.LABEL.label_end).where(F.col("user_id") == 10 ** 9).first()
    assert (lab["order_num"], lab["pred_date"], lab["has_order"]) == (0, 0, False)


def test_quintile_edges_are_exact_over_many_values(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(2.0, 50.0, 3001), 1)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "price double").repartition(7)
    edges = spark.range(1).select(enrich.quintile_edges(df, ["price"])["price"].alias("e")).first()["e"]
    assert np.allclose(edges, np.quantile(values, [0, 0.2, 0.4, 0.6, 0.8, 1.0]), atol=1e-9)
    plan = spark.range(1).select(enrich.quintile_edges(df, ["price"])["price"].alias("e"))._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
