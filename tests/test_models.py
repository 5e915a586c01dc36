"""Trees against brute force, boosting with patience, node tables, the forest over several labels, folds."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprank.operators import trees
from shoprank.operators.trees import Shape
from shoprank.plans import models

#: Every row and feature in every tree, a bin per value.
PLAIN = dict(row_fraction=1.0, feature_fraction=1.0, bins=200, min_rows=5)


def _frame(spark, n=300, seed=5):
    rnd = random.Random(seed)
    rows = []
    for u in range(n):
        a = rnd.uniform(0, 10)
        b = None if rnd.random() < 0.2 else rnd.uniform(0, 5)
        y = 2 * a + (b or 0) + rnd.gauss(0, 0.5)
        rows.append((u, a, b, y, float(max(0, round(a / 3))), bool(y > 10)))
    return spark.createDataFrame(rows, "user_id long, a double, b double, order_num double, pred_date double, has_order boolean")


def _mse(df, col, truth):
    return df.agg(F.avg((F.col(col) - F.col(truth)) ** 2)).first()[0]


def brute_tree(x, y, depth, min_rows):
    """Splits ``(path, feature, threshold, missing_left)`` of a tree over rows ``x`` (None: missing) with target vectors ``y``."""
    def score(rows):
        return (y[rows].sum(axis=0) ** 2).sum() / len(rows)

    def grow(rows, path, left):
        best = None
        for side in (False, True):
            for f in range(len(x[0])):
                values = sorted({x[r][f] for r in rows if x[r][f] is not None})
                for t in values[:-1] if not any(x[r][f] is None for r in rows) else values:
                    lo = [r for r in rows if (side if x[r][f] is None else x[r][f] <= t)]
                    hi = [r for r in rows if r not in set(lo)]
                    if min(len(lo), len(hi)) < min_rows:
                        continue
                    gain = score(lo) + score(hi) - score(rows)
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = (gain, f, t, side, lo, hi)
        if best is None or not left:
            return {}
        gain, f, t, side, lo, hi = best
        return {path: (f, t, side, round(gain, 6))} | grow(lo, path + "L", left - 1) | grow(hi, path + "R", left - 1)

    return grow(list(range(len(x))), "", depth)


def splits_of(tree, edges):
    """The same from a fitted tree; a threshold beyond the last edge is the largest value."""
    def walk(n, path):
        f = int(tree.feature[n])
        if f < 0:
            return {}
        cut = int(tree.cut[n])
        t = float(edges[f][cut]) if cut < len(edges[f]) else None
        return {path: (f, t, bool(tree.missing_left[n]), round(float(tree.gain[n]), 6))} | walk(tree.left[n], path + "L") | walk(tree.right[n], path + "R")

    return walk(0, "")


def same_splits(got, want):
    assert got.keys() == want.keys()
    for k, (f, t, side, gain) in got.items():
        assert (f, gain) == (want[k][0], want[k][3]) and (t is None or (t, side) == want[k][1:3])


def test_boosted_tree_equals_brute_force(spark):
    rnd = random.Random(8)
    x = [(rnd.randrange(12), None if rnd.random() < 0.3 else rnd.randrange(9)) for _ in range(200)]
    y = [3.0 * (a > 6) + (9 if b is None else b) + rnd.random() for a, b in x]
    df = spark.createDataFrame([(i, float(a), None if b is None else float(b), v) for i, ((a, b), v) in enumerate(zip(x, y))],
                               "user_id long, a double, b double, y double").repartition(3)
    m = trees.boost(df, ["a", "b"], [F.col("y")], [F.lit(1)], rounds=1, rate=1.0, shape=Shape(depth=3, **PLAIN))
    want = brute_tree(x, (np.array(y) - np.mean(y))[:, None], 3, 5)
    same_splits(splits_of(m.trees[0][0], m.edges), want)
    assert any(side for _, _, side, _ in want.values()) or any(t is None for _, t, _, _ in want.values()) or len(want) == 7


def test_missing_values_go_with_the_high_ones_in_one_split(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float(i % 4), 10.0 if i % 4 in (0, 3) else 1.0) for i in range(80)],
                               "user_id long, a double, y double")
    m = trees.boost(df, ["a"], [F.col("y")], [F.lit(1)], rounds=1, rate=1.0, shape=Shape(depth=1, **PLAIN))
    t = m.trees[0][0]
    assert len(t.feature) == 3 and m.edges[0][t.cut[0]] == 2.0 and not t.missing_left[0]
    out = trees.with_predictions(df, m, ["p"]).where(F.abs(F.col("p") - F.col("y")) > 1e-9)
    assert out.count() == 0


def test_boosting_stops_by_patience_at_the_best_round(spark):
    df = _frame(spark, 240).repartition(2)
    role = F.when(F.col("user_id") % 3 == 0, 2).otherwise(1)
    m = trees.boost(df, ["a", "b"], [F.col("order_num"), F.col("pred_date")], [role, role], rounds=60, patience=4, rate=0.6,
                    shape=Shape(depth=3, min_rows=5), block=7)
    for own, errors in zip(m.trees, m.errors):
        best = errors.index(min(errors))
        assert len(own) == best and len(errors) == best + 5 < 60
    held = trees.with_predictions(df, m, ["p", "q"]).where("user_id % 3 = 0")
    assert abs(_mse(held, "p", "order_num") - min(m.errors[0])) < 1e-9  # the written predictions add up to the model's


def test_slow_learning_goes_past_a_hundred_rounds(spark):
    df = _frame(spark, 200).repartition(1)
    role = F.when(F.col("user_id") % 3 == 0, 2).otherwise(1)
    m = trees.boost(df, ["a"], [F.col("order_num")], [role], rounds=115, patience=10, rate=0.01, shape=Shape(depth=1, min_rows=5))
    assert len(m.trees[0]) > 100


def test_many_tasks_give_the_same_trees(spark, monkeypatch):
    df = _frame(spark, 300).repartition(3)
    fit = lambda: trees.boost(df, ["a", "b"], [F.col("order_num")], [F.lit(1)], rounds=2, rate=0.5, shape=Shape(depth=3))
    few = fit()
    monkeypatch.setattr(trees, "FILE_BYTES", 2000)
    monkeypatch.setattr(trees, "FEATURE_BLOCK", 1)
    for a, b in zip(few.trees[0], fit().trees[0]):
        assert a.feature.tolist() == b.feature.tolist() and a.cut.tolist() == b.cut.tolist()
        assert np.allclose(a.value, b.value)


def test_shuffled_sums_give_the_same_trees(spark, monkeypatch):
    df = _frame(spark, 300).repartition(3)
    fit = lambda: trees.boost(df, ["a", "b"], [F.col("order_num")], [F.lit(1)], rounds=2, rate=0.5, shape=Shape(depth=3))
    few = fit()
    for name, value in (("DIRECT_BYTES", 0), ("TASK_BYTES", 1000), ("FEATURE_BLOCK", 1)):
        monkeypatch.setattr(trees, name, value)
    for a, b in zip(few.trees[0], fit().trees[0]):
        assert a.feature.tolist() == b.feature.tolist() and a.cut.tolist() == b.cut.tolist()
        assert np.allclose(a.value, b.value)


def test_a_matrix_fills_all_cores(spark, monkeypatch):
    monkeypatch.setattr(trees, "TASK_BYTES", 1 << 10)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 12)
    m = trees.Matrix(spark.range(400).withColumn("f", F.lit(0.0)), 214)
    try:
        assert m.files == 12 and m.df().count() == 400
    finally:
        m.remove()


def test_bin_edges_of_more_columns_than_a_block(spark):
    names = [f"c{i}" for i in range(37)]
    df = spark.range(500).select(*[(F.col("id") * (i + 1) % 101).cast("double").alias(c) if i != 20 else F.lit(None).cast("double").alias(c)
                                   for i, c in enumerate(names)])
    df = df.withColumn("c3", F.when(F.col("c3") > 50, F.lit(float("nan"))).otherwise(F.col("c3")))
    got, rows = trees.bin_edges(df, names, 8), df.toPandas()
    for i, c in enumerate(names):
        v = np.sort(rows[c].dropna().to_numpy(float))
        want = sorted({v[max(0, int(np.ceil(len(v) * k / 8)) - 1)] for k in range(1, 8)} - {v[-1]}) if len(v) else []
        assert got[i].tolist() == want
    seen = []
    monkey = trees.F.array
    trees.F.array = lambda *cols: seen.append(len(cols)) or monkey(*cols)
    try:
        trees.bin_edges(df.limit(5), names, 8)
    finally:
        trees.F.array = monkey
    assert seen == [3]  # a row becomes three, not one per column


def test_leaves_by_columns_equal_a_walk(spark):
    t = trees.Tree()
    for _ in range(5):
        t.add(1.0, np.zeros(1))
    t.feature[0], t.cut[0], t.missing_left[0], t.left[0], t.right[0] = 1, 3, True, 1, 2
    t.feature[2], t.cut[2], t.missing_left[2], t.left[2], t.right[2] = 0, 0, False, 3, 4
    bins = np.array([[a, b] for a in range(8) for b in range(8)], np.uint8)
    want = [1 if b <= 3 or b == 7 else 3 if a <= 0 else 4 for a, b in bins.tolist()]
    assert t.frozen().leaves(np.ascontiguousarray(bins.T), 7, 64).tolist() == want == t.leaves_of(bins, 7).tolist()


def test_predictions_carry_only_the_kept_columns(spark):
    df = _frame(spark)
    pred, _ = models.train_predict_two_target(df, df, ["a", "b"], rounds=1)
    assert pred.columns == ["user_id", "order_num", "pred_date"]
    python = next(x for x in pred._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in x)
    assert "a#" not in python and "b#" not in python


def test_training_frames_join_the_order_lines_once(spark):
    from shoprank.plans import catalog

    _, train, test, _ = catalog._ml_frames(spark, "/root/testdata/sf0.001")
    for df in (train, test):
        assert not any("lineitem" in f or "orders.parquet" in f for f in df.inputFiles())


def test_two_targets_beat_the_mean_and_replay_from_the_node_table(spark):
    df = _frame(spark)
    pred, m = models.train_predict_two_target(df, df.drop("order_num", "pred_date"), ["a", "b"],
                                              date_only_buyers="has_order", rounds=12, rate=0.3)
    assert pred.count() == 300 and pred.where(F.col("order_num").isNull()).count() == 0
    plan = pred._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    j = pred.withColumnRenamed("order_num", "p").join(df, "user_id")
    mean = df.agg(F.avg("order_num")).first()[0]
    assert _mse(j, "p", "order_num") < 0.2 * _mse(j.withColumn("m", F.lit(mean)), "m", "order_num")
    nodes, rows = trees.node_table(spark, m, ["order_num", "pred_date"]).toPandas(), df.select("user_id", "a", "b").toPandas()
    con = duckdb.connect()
    con.register("nodes", nodes)
    con.register("x", rows)
    replay = con.sql("""
        WITH RECURSIVE long AS (SELECT user_id, 'a' AS feature, a AS v FROM x UNION ALL SELECT user_id, 'b', b FROM x),
        walk AS (
          SELECT user_id, model, tree, 0 AS node FROM x, (SELECT DISTINCT model, tree FROM nodes)
          UNION ALL
          SELECT w.user_id, w.model, w.tree, CAST(CASE WHEN CASE WHEN l.v IS NULL OR isnan(l.v) THEN n.missing_left ELSE l.v <= n.threshold END
            THEN n."left" ELSE n."right" END AS INTEGER)
          FROM walk w JOIN nodes n USING (model, tree, node) JOIN long l ON l.user_id = w.user_id AND l.feature = n.feature)
        SELECT user_id, sum(value) FILTER (WHERE model = 'order_num'), sum(value) FILTER (WHERE model = 'pred_date')
        FROM walk JOIN nodes USING (model, tree, node) WHERE nodes.feature IS NULL GROUP BY user_id""").fetchall()
    got = {r["user_id"]: (r["order_num"], r["pred_date"]) for r in pred.collect()}
    assert len(replay) == 300 and all(np.allclose(got[u], (a, b)) for u, a, b in replay)


def test_importance_of_a_hand_built_tree(spark):
    t = trees.Tree()
    for cover, value in ((10, 0.0), (6, 1.0), (4, 2.0), (3, 3.0), (3, 4.0)):
        t.add(cover, np.array([value]))
    t.feature[0], t.left[0], t.right[0], t.gain[0] = 1, 1, 2, 7.5
    t.feature[1], t.left[1], t.right[1], t.gain[1] = 1, 3, 4, 1.25
    m = trees.Ensemble(["a", "b"], [np.array([1.0]), np.array([2.0])], np.array([0.5]), [[t.frozen()]])
    assert [tuple(r) for r in models.feature_importance(spark, m, ["y"]).collect()] == [("y", "b", 2, 8.75), ("y", "a", 0, 0.0)]


def test_stacked_and_bagged_models(spark):
    df = _frame(spark, 200)
    p = models.stacked_bagged_regressor(df, df.drop("order_num"), ["a", "b"], "order_num", k=3, bags=2, rounds=12, patience=3, rate=0.3,
                                        shape=Shape(depth=3, min_rows=5))
    assert p.count() == 200 and p.where(F.col("prediction").isNull()).count() == 0
    assert _mse(p.join(df, "user_id"), "prediction", "order_num") < 0.3 * df.agg(F.variance("order_num")).first()[0]


def test_forest_over_two_labels_equals_brute_force(spark):
    rnd = random.Random(2)
    x = [(rnd.randrange(8), rnd.randrange(5)) for _ in range(200)]
    lab = [(int(a > 3), -1 if b < 2 else b * (a > 5)) for a, b in x]
    df = spark.createDataFrame([(i, float(a), float(b), p, q) for i, ((a, b), (p, q)) in enumerate(zip(x, lab))],
                               "user_id long, a double, b double, p long, q long").repartition(2)
    f = trees.class_forest(df, ["a", "b"], ["p", "q"], 1, Shape(depth=3, **PLAIN))
    kinds = [sorted({v[j] for v in lab}) for j in (0, 1)]
    hot = np.array([[v[j] == k for j in (0, 1) for k in kinds[j]] for v in lab], float)
    same_splits(splits_of(f.trees[0], f.edges), brute_tree(x, hot, 3, 5))


def test_forest_predicts_classes_of_all_labels(spark):
    df = _frame(spark, 200).withColumn("y", F.when(F.col("a") > 5, 1).otherwise(-1)).withColumn("z", F.lit(7))
    f = models.per_label_forest(df, df.drop("y", "z"), ["a", "b"], ["y", "z"], num_trees=5)
    acc = f.join(df.select("user_id", F.col("y").alias("t")), "user_id").agg(F.avg((F.col("y") == F.col("t")).cast("double")), F.min("z"), F.max("z")).first()
    assert acc[0] > 0.9 and acc[1] == acc[2] == 7
    many = spark.createDataFrame([(u, float(u), u % 150 - 1) for u in range(600)], "user_id long, a double, y long")
    out = models.per_label_forest(many, many.drop("y"), ["a"], ["y"], num_trees=2)
    assert out.count() == 600 and out.where(F.col("y").isNull() | (F.col("y") < -1) | (F.col("y") > 148)).count() == 0
    with pytest.raises(ValueError, match="classes"):
        trees.class_forest(many, ["a"], ["y"], 1, most_classes=50)


def test_prepare_matrix_sentinel_and_flags(spark):
    df = _frame(spark, 20)
    m = models.prepare_matrix(df, ["a", "b"])
    assert m.where(F.col("b").isNull()).count() == 0
    assert m.where(F.col("b_missing") == 1).count() == df.where(F.col("b").isNull()).count()
    assert m.where(F.col("b_missing") == 1).agg(F.max("b")).first()[0] == models.SENTINEL


def test_folds_differ_by_one_row_at_most(spark):
    df = _frame(spark, 503).repartition(6)
    for stratify in (None, "has_order"):
        f = models.exact_folds(df, 5, stratify=stratify)
        sizes = {}
        for r in f.groupBy(*([stratify] if stratify else []), "fold").count().collect():
            sizes.setdefault(r[0] if stratify else None, []).append(r["count"])
        assert f.count() == 503 and all(len(v) == 5 and max(v) - min(v) <= 1 for v in sizes.values())


def test_rank_within_groups_is_the_row_number(spark):
    from shoprank.operators.rangerank import with_rank

    df = spark.range(5000).select((F.col("id") % 7 % 3).alias("g"), F.xxhash64("id").alias("o"), F.when(F.col("id") % 2 == 0, "x").alias("n")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = with_rank(df, ["o"], ["g", "n"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by = {}
    for r in sorted(rows, key=lambda r: r["o"]):
        by.setdefault((r["g"], r["n"]), []).append(r["rank"])
    assert len(rows) == 5000 and all(v == list(range(len(v))) for v in by.values())
