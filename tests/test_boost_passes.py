"""Boosting passes: what tasks add up, exact sums, and the ways around what the driver keeps and a task opens itself."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprank.operators import trees
from shoprank.operators.trees import Shape


@pytest.fixture(scope="module")
def rows(spark):
    x = [F.rand(k) for k in range(4)]
    df = spark.range(900).select(F.col("id").alias("user_id"), *[F.round(v * 20).alias(f"c{k}") for k, v in enumerate(x)])
    df = df.withColumn("c3", F.when(F.col("c3") > 4, F.col("c3"))).withColumn("y", F.round(F.col("c0") * F.col("c1") + 8 * F.rand(9)) / 8)
    return spark.createDataFrame(df.collect(), df.schema)


def fit(df, **kw):
    role = [F.lit(1), F.when(F.col("user_id") % 4 == 0, 2).otherwise(1)]
    return trees.boost(df, ["c0", "c1", "c2", "c3"], [F.col("y")] * 2, role, **{**dict(rounds=2, rate=0.3, shape=Shape(min_rows=5), patience=50), **kw})


def same(a, b):
    assert np.array_equal(a.first, b.first) and [len(t) for t in a.trees] == [len(t) for t in b.trees]
    for s, t in zip(sum(a.trees, []), sum(b.trees, [])):
        assert all(np.array_equal(getattr(s, k), getattr(t, k)) for k in ("feature", "cut", "missing_left", "left", "right", "gain", "cover", "value"))


def test_tasks_add_up_the_smaller_child_only(spark, rows, monkeypatch):
    seen, run = [], trees.run_pass
    monkeypatch.setattr(trees, "run_pass", lambda matrix, work, kept: seen.append((work.grow, work.count, work.open)) or run(matrix, work, kept))
    m = fit(rows, rounds=1)
    level = [(len(count[0]), len(nodes[0])) for _, count, nodes in seen[:3]]
    assert level == [(1, 1), (1, 2), (2, 4)]
    tree = m.trees[0][0]
    for n in np.flatnonzero(tree.feature >= 0):  # and the larger one is what is left
        assert tree.cover[tree.left[n]] + tree.cover[tree.right[n]] == tree.cover[n]


def test_sums_do_not_depend_on_the_tasks(spark, rows, monkeypatch):
    one = fit(rows.coalesce(1))
    monkeypatch.setattr(trees, "SMALL_BYTES", 4000)
    monkeypatch.setattr(trees, "TASK_BYTES", 9000)
    monkeypatch.setattr(trees, "CHUNK_BYTES", 3000)
    same(one, fit(rows.repartition(5)))


def test_trees_are_the_same_where_the_driver_keeps_no_sums(spark, rows, monkeypatch):
    want = fit(rows)
    monkeypatch.setattr(trees, "SMALL_BYTES", 4000)
    monkeypatch.setattr(trees, "FEATURE_BLOCK", 3)
    monkeypatch.setattr(trees, "DIRECT_BYTES", 0)
    same(want, fit(rows))
    monkeypatch.setattr(trees, "KEPT_BYTES", 0)
    same(want, fit(rows))


def test_files_that_a_task_cannot_open_come_from_spark(spark, rows, monkeypatch):
    want = fit(rows, rounds=3, block=2)
    monkeypatch.setattr(trees, "urlparse", lambda x: SimpleNamespace(scheme="hdfs", path=x))
    same(want, fit(rows, rounds=3, block=2))


def test_pairs_of_features_count_like_single_ones(spark):
    rng = np.random.default_rng(3)
    columns, gap = rng.integers(0, 5, (3, 700)).astype(np.uint8), np.rint(rng.normal(size=700) * 1000)
    for nodes in (1, 2):
        at = np.arange(700) % nodes
        got = np.zeros((nodes, 3, 5, 2))
        trees._add_columns(got, columns, np.arange(3), np.arange(700), at, gap, None)
        for n in range(nodes):
            for j in range(3):
                for v in range(5):
                    of = (at == n) & (columns[j] == v)
                    assert got[n, j, v].tolist() == [of.sum(), gap[of].sum()]
