"""End-to-end flows matching the reference's entry scripts.

* :func:`run_baseline` — features of two cutoffs (train with labels, predict
  with placeholders), weighted count model and buyers-only date model,
  ranked submission with a date cap.
* :func:`run_refactored` — features and labels, one model per label, then
  either the score against the month's first orders (validation) or the
  submission.
* :func:`run_prototype` — group totals and labels of several cutoffs stacked,
  one forest over the labels, merged and capped submission.
* :func:`run_pagerank` — edge list to ranks, persisted, with the top list.

Each returns DataFrames (and writes only where a path is given), so a caller
can inspect the plans or run them on a cluster session.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_months
from ..operators import enrich, graph, labels, prototype, ranking
from ..schema import RetailBundle
from ..sources import sinks
from . import models, pipeline
from .windows import feature_windows


def run_baseline(b: RetailBundle, predict_begin: date, cap: date, n: int = ranking.SUBMISSION_SIZE,
                 action_windows=None, pair_sources=None, out: str | None = None, **kw) -> DataFrame:
    """Baseline flow: train on the month before ``predict_begin``, predict that month."""
    train_w = feature_windows(add_months(predict_begin, -1))
    test_w = feature_windows(predict_begin)
    train = pipeline.build_baseline_features(b, train_w.features, train_w.label_begin, train_w.label_end,
                                             action_windows, True, pair_sources)
    test = pipeline.build_baseline_features(b, test_w.features, test_w.label_begin, test_w.label_end,
                                            action_windows, False, pair_sources)
    cols = [c for c in train.columns if c not in ("user_id", "Label_30_101_BuyNum", "Label_30_101_FirstTime")]
    train = (train.withColumn("confidence", ranking.regularity_weight(train))
             .withColumn("has_order", F.col("Label_30_101_BuyNum") > 0))
    pred, _ = models.train_predict_two_target(
        train, test, cols, count_label="Label_30_101_BuyNum", date_label="Label_30_101_FirstTime",
        count_weight="confidence", date_only_buyers="has_order", **kw)
    sub = ranking.submission_baseline(pred, predict_begin, cap, n)
    if out:
        sinks.write_submission(sub, out)
    return sub


def run_refactored(b: RetailBundle, test_begin: date, validation: bool = False, n: int = ranking.SUBMISSION_SIZE,
                   action_windows=None, pair_sources=None, out: str | None = None, now: datetime | None = None, **kw) -> DataFrame:
    """Refactored flow: returns the score row in validation mode, else the submission.

    The list goes to ``out`` with the time (``now``) in its name (S5).
    """
    if validation:
        return models.holdout_validation(b, test_begin, n=n, action_windows=action_windows,
                                         pair_sources=pair_sources, **kw)
    train_w = feature_windows(add_months(test_begin, -1))
    test_w = feature_windows(test_begin)
    train_x = pipeline.build_features(b, train_w.features, action_windows, pair_sources)
    test_x = pipeline.build_features(b, test_w.features, action_windows, pair_sources)
    y = labels.build_labels(b.user, enrich.order_with_category(b), train_w.label_begin, train_w.label_end)
    cols = [c for c in train_x.columns if c != "user_id"]
    pred, _ = models.train_predict_two_target(train_x.join(y, "user_id"), test_x, cols, **kw)
    sub = ranking.submission_refactored(pred, test_w.label_begin, n)
    if out:
        sinks.write_submission(sub, sinks.timestamped_name(out, now))
    return sub


def run_prototype(b: RetailBundle, train_label_begins: list[date], predict_begin: date,
                  cate_types=("tg",), n: int = ranking.SUBMISSION_SIZE, feature_months: int = 6,
                  num_trees: int = 10, out: str | None = None, now: datetime | None = None) -> DataFrame:
    """Prototype flow: stacked cutoffs (U1), one forest over the labels, merged and capped submission."""
    sku = enrich.prototype_skus(b.sku)
    osc = enrich.prototype_order_scores(b.order, b.comment)
    xs, ys = [], []
    for lb in train_label_begins:
        fb, fe = add_months(lb, -feature_months), lb - timedelta(days=1)
        f = prototype.prototype_features(b.action, osc, sku, fb, fe, cate_types)
        y = prototype.prototype_labels(osc, sku, lb, add_months(lb, 1) - timedelta(days=1), f, cate_types)
        xs.append((lb, f))
        ys.append((lb, y.select("user_id", *[F.col(c).alias(f"y_{c}") for c in y.columns if c != "user_id"])))
    train = labels.stack_periods(xs).join(labels.stack_periods(ys), ["user_id", "cutoff"])
    pb, pe = predict_begin, add_months(predict_begin, 1) - timedelta(days=1)
    test = prototype.prototype_features(b.action, osc, sku, add_months(pb, -feature_months), pb - timedelta(days=1),
                                        cate_types)
    cols = [c for c in test.columns if c != "user_id"]
    ycols = [c for c in train.columns if c.startswith("y_")]
    pred = models.per_label_forest(train, test, cols, ycols, num_trees=num_trees)
    pred = pred.select("user_id", *[F.col(c).alias(c[2:]) for c in ycols])
    sub = ranking.submission_prototype(pred, pb, pe, n)
    if out:
        sinks.write_submission(sub, sinks.timestamped_name(out, now))
    return sub


def run_pagerank(edges: DataFrame, ranks_path: str | None = None, top_path: str | None = None,
                 top_n: int = 100, **kw) -> tuple[DataFrame, DataFrame]:
    """PageRank flow: ranks (persisted when a path is given) and the top list."""
    ranks = graph.pagerank(edges, **kw)
    if ranks_path:
        sinks.write_ranks(ranks, ranks_path)
    if top_path:
        sinks.write_top_ranks(ranks, top_path, top_n)
    return ranks, graph.top_ranks(ranks, top_n)
