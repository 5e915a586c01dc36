"""Named queries over the synthetic tables, one per operator family.

Each query takes ``(spark, sf_dir)``, reads the given tables through the
adapters in :mod:`shoprank.sources`, and returns a lazy DataFrame. The keys
are the names used by ``__spark_entry__.queries()``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import enrich, features, graph, labels, pairs, prototype, ranking, scoring
from ..operators.user_agg import Agg
from ..plans import flows, models, pipeline
from ..plans.windows import Win, feature_windows
from ..sources import edges as edges_src
from ..sources import retail, sinks
from ..session import read_back, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The windows of the synthetic data (FIXTURES.md §3).
LABEL_BEGIN = date(2001, 2, 1)
ORDER_WINDOWS = feature_windows(LABEL_BEGIN)  # 2001-01-01 / 2000-11-01 / 2000-08-01 .. 2001-01-31
ACTION_WINDOWS = (
    Win("1", date(2024, 1, 24), date(2024, 1, 30)),
    Win("3", date(2024, 1, 15), date(2024, 1, 30)),
    Win("6", date(2024, 1, 1), date(2024, 1, 30)),
)
WIDEST = ORDER_WINDOWS.features[-1]


CHECK_DECIMALS = 6  # DOUBLE results of the checked queries are rounded to this many places


def rounded(df: DataFrame, places: int = CHECK_DECIMALS) -> DataFrame:
    """Round every DOUBLE column (results compared across engines whose float sums differ in the last bits)."""
    return df.selectExpr(*[f"round(`{f.name}`, {places}) AS `{f.name}`" if f.dataType.simpleString() == "double"
                           else f"`{f.name}`" for f in df.schema.fields])


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("a1_target_orders_6m")
def a1_target_orders_6m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + F1 + F2 + J3 + A1 + J7: distinct target-group orders per customer, last 6 months."""
    b = retail.retail_from_testdata(spark, sf_dir)
    of = enrich.order_fact(b)
    return features.anchor(b.user.select("user_id"), features.target_order_count(of, WIDEST))


def _shared(spark: SparkSession, sf_dir: str, begin: date = WIDEST.begin, end: date = WIDEST.end, shipped: bool = True):
    """The retail tables and the sides of the action-to-order gap over order lines of a time, joined and written once."""
    lines = retail.order_lines_from_testdata(spark, sf_dir, begin, end, shipped, shared_path(spark, "order-lines"))
    return retail.retail_from_testdata(spark, sf_dir, lines), retail.pair_sources_from_testdata(spark, sf_dir, lines)


def _users(b) -> DataFrame:
    return b.user.select("user_id")


@query("x2_order_features")
def x2_order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 refactored (A1-A25, A27, A28): order features of the 1/3/6-month windows."""
    b, _ = _shared(spark, sf_dir, shipped=False)
    f = features.refactored_order_features(enrich.order_fact(b), ORDER_WINDOWS.features)
    return rounded(features.anchor(_users(b), f))


@query("x2_baseline_order_features")
def x2_baseline_order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 baseline (A1-A26, A28) over the enriched order lines."""
    b, _ = _shared(spark, sf_dir, shipped=False)
    f = features.baseline_order_features(enrich.enrich_orders(b), ORDER_WINDOWS.features)
    return rounded(features.anchor(_users(b), f))


@query("x3_action_features")
def x3_action_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 refactored (A29-A31, A33): action features of three nested windows."""
    b = retail.retail_from_testdata(spark, sf_dir)
    f = features.refactored_action_features(enrich.action_fact(b), ACTION_WINDOWS)
    return features.anchor(_users(b), f)


@query("x3_baseline_action_features")
def x3_baseline_action_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 baseline (A32-A35) over the enriched actions."""
    b = retail.retail_from_testdata(spark, sf_dir)
    f = features.baseline_action_features(enrich.enrich_actions(b), ACTION_WINDOWS)
    return features.anchor(_users(b), f)


@query("x4_action_order_features")
def x4_action_order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 + A36 refactored: mean days from action to a same-or-later order, per window."""
    b, (pa, po) = _shared(spark, sf_dir)
    cat = enrich.sku_category(b.sku)
    f = pairs.refactored_action_order_features(pa.join(cat, "sku_id", "left"), po.join(cat, "sku_id", "left"),
                                               ORDER_WINDOWS.features)
    return rounded(features.anchor(_users(b), f))


@query("x4_baseline_action_order_gap")
def x4_baseline_action_order_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 + A36 baseline: mean days from action to a strictly later order, per window."""
    b, (pa, po) = _shared(spark, sf_dir)
    f = pairs.baseline_action_order_features(pa, po, ORDER_WINDOWS.features)
    return rounded(features.anchor(_users(b), f))


LABEL = ORDER_WINDOWS  # label window: 2001-02-01 .. 2001-02-28
PROTO_FEATURE = (date(2000, 8, 1), date(2001, 1, 31))
PROTO_GROUPS = ("30", "101", "tg", "ntg")
TOP_N = 300  # list size for the registered submission queries (the 50,000 default never bites here)
BASELINE_CAP = date(2001, 2, 14)


@query("x6_labels")
def x6_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 refactored: order_num (A40), pred_date (A41), has_order (D10), 0-filled, per user."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return labels.build_labels(b.user, enrich.order_with_category(b), LABEL.label_begin, LABEL.label_end)


@query("x6_baseline_labels")
def x6_baseline_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 baseline: user attributes + Label_30_101_BuyNum / Label_30_101_FirstTime."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return labels.build_baseline_labels(b.user, enrich.enrich_orders(b), LABEL.label_begin, LABEL.label_end)


@query("a42_inference_labels")
def a42_inference_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-period frame with both labels set to -1."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return labels.inference_labels(b.user)


@query("a43_ground_truth")
def a43_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order date per user in the label month, all categories."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return labels.ground_truth(b.order, LABEL.label_begin, LABEL.label_end)


@query("u1_stacked_periods")
def u1_stacked_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of three consecutive label months stacked with a cutoff column."""
    b = retail.retail_from_testdata(spark, sf_dir)
    of = enrich.order_with_category(b)
    frames = []
    for m in (12, 1, 2):
        w = feature_windows(date(2000 if m == 12 else 2001, m, 1))
        frames.append((w.label_begin, labels.label_aggregates(of, w.label_begin, w.label_end)))
    return labels.stack_periods(frames)


@query("f10_sku_bands")
def f10_sku_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 + F10: prototype sku table (recoded category, price and para_1 quintile bands)."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return enrich.prototype_skus(b.sku)


@query("j6_prototype_order_scores")
def j6_prototype_order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + F7 + F13: order rows with re-attached scores as (key, score, weight)."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return enrich.prototype_order_scores(b.order, b.comment)


def _proto(spark, sf_dir):
    b = retail.retail_from_testdata(spark, sf_dir)
    return b, enrich.prototype_skus(b.sku), enrich.prototype_order_scores(b.order, b.comment)


@query("x7_prototype_features")
def x7_prototype_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, star, order, good and bad totals per group."""
    b, sku, osc = _proto(spark, sf_dir)
    return prototype.prototype_features(b.action, osc, sku, *PROTO_FEATURE, PROTO_GROUPS)


@query("x7_prototype_labels")
def x7_prototype_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-order day and order rows per group, on the feature users."""
    b, sku, osc = _proto(spark, sf_dir)
    feats = prototype.prototype_features(b.action, osc, sku, *PROTO_FEATURE, PROTO_GROUPS)
    return prototype.prototype_labels(osc, sku, LABEL.label_begin, LABEL.label_end, feats, PROTO_GROUPS)


@query("u2_align_users")
def u2_align_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 + J11 + U2 in explicit form: semi join, anti join, append with -1."""
    b, sku, osc = _proto(spark, sf_dir)
    feats = prototype.prototype_features(b.action, osc, sku, *PROTO_FEATURE, PROTO_GROUPS)
    lab = prototype.prototype_label_aggregates(osc, sku, LABEL.label_begin, LABEL.label_end, PROTO_GROUPS)
    return prototype.align_to_users(lab, feats)


def _order_count_prediction(b) -> DataFrame:
    """A stand-in prediction: last-6-month target orders and first order day."""
    specs = [Agg("order_num", "nunique", "o_id", "30_101", "6"), Agg("pred_date", "min", "o_day", "30_101", "6")]
    f = features.user_window_agg(enrich.order_fact(b), specs, (WIDEST,), features.group_predicates(), "o_date")
    return f.where(F.col("order_num").isNotNull())


@query("k1_top_users")
def k1_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + W3: top users by last-6-month target orders, ranked (ties by user_id)."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return ranking.top_ranked(_order_count_prediction(b), "order_num", TOP_N).select("user_id", "order_num", "rank")


@query("x9_submission_refactored")
def x9_submission_refactored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 refactored: ranked list dated begin + predicted day offset."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return ranking.submission_refactored(_order_count_prediction(b), LABEL.label_begin, TOP_N)


def _baseline_prediction(b) -> DataFrame:
    specs = [Agg(f"OM{w.label}_o_date_cate_30_101_gap_var", "gap_std", "o_date", "30_101", w.label)
             for w in ORDER_WINDOWS.features]
    specs += [Agg("cnt6", "nunique", "o_id", "30_101", "6"), Agg("first6", "min", "day", "30_101", "6")]
    f = features.user_window_agg(enrich.enrich_orders(b), specs, ORDER_WINDOWS.features,
                                 features.group_predicates(), "o_date")
    return f.select("user_id", (F.col("cnt6") * ranking.regularity_weight(f)).alias("Label_30_101_BuyNum"),
                    F.col("first6").alias("Label_30_101_FirstTime"))


@query("x8_regularity_weight")
def x8_regularity_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 + C6 + C8: regularity weight from the 1/3/6-month gap deviations, per user."""
    b = retail.retail_from_testdata(spark, sf_dir)
    specs = [Agg(f"OM{w.label}_o_date_cate_30_101_gap_var", "gap_std", "o_date", "30_101", w.label)
             for w in ORDER_WINDOWS.features]
    f = features.user_window_agg(enrich.enrich_orders(b), specs, ORDER_WINDOWS.features,
                                 features.group_predicates(), "o_date")
    f = features.anchor(_users(b), f)
    return rounded(f.select("user_id", ranking.regularity_weight(f).alias("weight")))


@query("x9_submission_baseline")
def x9_submission_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 baseline: weighted count ranking, truncated day offset, date cap."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return ranking.submission_baseline(_baseline_prediction(b), LABEL.label_begin, BASELINE_CAP, TOP_N)


@query("x9_submission_prototype")
def x9_submission_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 prototype: F14 invalidation, N14 merge over groups, mid-month cap."""
    b, sku, osc = _proto(spark, sf_dir)
    feats = prototype.prototype_features(b.action, osc, sku, *PROTO_FEATURE, PROTO_GROUPS)
    lab = prototype.prototype_labels(osc, sku, LABEL.label_begin, LABEL.label_end, feats, PROTO_GROUPS)
    return ranking.submission_prototype(lab, LABEL.label_begin, LABEL.label_end, TOP_N)


@query("x10_score")
def x10_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, S2, S of the refactored submission against the label-month truth."""
    b = retail.retail_from_testdata(spark, sf_dir)
    truth = labels.ground_truth(b.order, LABEL.label_begin, LABEL.label_end)
    pred = ranking.submission_refactored(_order_count_prediction(b), LABEL.label_begin, TOP_N)
    return rounded(scoring.score(truth, pred))


PR_FIXED_ITER = 10  # fixed iteration count of the SQL-checked PageRank query
RANK_NODE = 15


def _edges(spark, sf_dir):
    return edges_src.edges_from_testdata(spark, sf_dir)


@query("x14_pagerank")
def x14_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PageRank of the customer -> part graph, 10 Jacobi updates (ranks rounded to 10 places)."""
    r = graph.pagerank(_edges(spark, sf_dir), rtol=None, max_iter=PR_FIXED_ITER)
    return r.select("id", F.round("rank", 10).alias("rank"))


@query("x14_pagerank_converged")
def x14_pagerank_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X14 with the reference stopping rule (rtol 1e-5, atol 1e-8), ranks rounded to 6 places."""
    return rounded(graph.pagerank(_edges(spark, sf_dir)))


@query("k2_top100_ranks")
def k2_top100_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + S7 content: the 100 highest converged ranks with their position (ordered first, then rounded)."""
    top = graph.top_ranks(graph.pagerank(_edges(spark, sf_dir)), 100)
    return top.withColumn("rank", F.round("rank", CHECK_DECIMALS))


@query("x15_rank_of")
def x15_rank_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converged rank of one node by id."""
    return rounded(graph.rank_of(graph.pagerank(_edges(spark, sf_dir)), RANK_NODE))


@query("a44_graph_counts")
def a44_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge, source, target, node, dead-end and dead-start counts."""
    return graph.graph_counts(_edges(spark, sf_dir))


@query("a45_degrees")
def a45_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out- and in-degree of every node."""
    return graph.degrees(_edges(spark, sf_dir))


@query("a46_degree_summary")
def a46_degree_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """describe() of out-degrees (sources) and in-degrees (targets)."""
    return rounded(graph.degree_summary(_edges(spark, sf_dir)))


@query("a47_degree_histogram")
def a47_degree_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree distributions cut at out < 40 and in < 200."""
    return graph.degree_histogram(_edges(spark, sf_dir), width=1, below={"out": 40, "in": 200})


@query("a47_degree_histogram_full")
def a47_degree_histogram_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole degree distributions."""
    return graph.degree_histogram(_edges(spark, sf_dir))


@query("x16_graph_profile")
def x16_graph_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, degree summary and full degree histograms in long form."""
    return rounded(graph.graph_profile(_edges(spark, sf_dir)))


@query("u3_all_nodes")
def u3_all_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node id."""
    return graph.all_nodes(_edges(spark, sf_dir))


@query("u4_dead_ends")
def u4_dead_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: nodes without out-edges."""
    return graph.dead_ends(_edges(spark, sf_dir))


@query("u5_dead_starts")
def u5_dead_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes without in-edges."""
    return graph.dead_starts(_edges(spark, sf_dir))


@query("s8_users")
def s8_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User table from customer."""
    return retail.users_from_testdata(spark, sf_dir)


@query("s8_skus")
def s8_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sku table from part (STANDARD parts have an unknown category)."""
    return retail.skus_from_testdata(spark, sf_dir)


@query("s8_orders")
def s8_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines from lineitem joined with orders."""
    return retail.orders_from_testdata(spark, sf_dir)


@query("s8_comments")
def s8_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments (scores) from order status."""
    return retail.comments_from_testdata(spark, sf_dir)


@query("s8_actions")
def s8_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions from events."""
    return retail.actions_from_testdata(spark, sf_dir)


@query("j1_enrich_orders")
def j1_enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + F11 + F12: order lines with comments, user and sku attributes, total price, date parts."""
    return enrich.enrich_orders(retail.retail_from_testdata(spark, sf_dir))


@query("j2_enrich_actions")
def j2_enrich_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + F11: actions with user and sku attributes and date parts."""
    return enrich.enrich_actions(retail.retail_from_testdata(spark, sf_dir))


@query("j3_j5_order_fact")
def j3_j5_order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + J4 + J5 + U6 + F6 + F11 + F12: refactored order fact."""
    return enrich.order_fact(retail.retail_from_testdata(spark, sf_dir))


@query("j3_action_fact")
def j3_action_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + F11: refactored action fact."""
    return enrich.action_fact(retail.retail_from_testdata(spark, sf_dir))


@query("w1_successive_gaps")
def w1_successive_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between successive target-group order days per user, last 6 months."""
    b = retail.retail_from_testdata(spark, sf_dir)
    of = enrich.order_fact(b)
    where = F.col("o_date").between(F.lit(WIDEST.begin), F.lit(WIDEST.end)) & F.col("cate").isin(30, 101)
    return features.successive_gaps(of, "o_date", where)


@query("f2_group_line_counts")
def f2_group_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 (N1): order lines and users per category group in each window."""
    b = retail.retail_from_testdata(spark, sf_dir)
    of = enrich.order_fact(b)
    return features.group_line_counts(of, ORDER_WINDOWS.features)


@query("c_scalar_functions")
def c_scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date parts, day differences, day offsets, caps, exp/ln/power, tolerance, casts."""
    b = retail.retail_from_testdata(spark, sf_dir)
    return features.scalar_showcase(b.order, LABEL.label_begin, LABEL.label_end, BASELINE_CAP)


@query("x5_build_features")
def x5_build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 refactored: user attributes + action, order and action-order features of 1/3/6 windows."""
    b, pairs = _shared(spark, sf_dir)
    return rounded(pipeline.build_features(b, ORDER_WINDOWS.features, ACTION_WINDOWS, pairs))


@query("x5_baseline_features")
def x5_baseline_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 baseline: user attributes + labels + OM/AM/GM features."""
    b, pairs = _shared(spark, sf_dir, WIDEST.begin, LABEL.label_end)
    return rounded(pipeline.build_baseline_features(b, ORDER_WINDOWS.features, LABEL.label_begin, LABEL.label_end,
                                            ACTION_WINDOWS, True, pairs))


TRAIN_WINDOWS = feature_windows(date(2001, 1, 1))  # train: features to 2000-12-31, labels of January 2001


def _ml_frames(spark, sf_dir):
    """Train (features + labels of the previous month) and test (current features) frames."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    # both periods under one set of names: the window labels are relative
    xtr = pipeline.build_features(b, TRAIN_WINDOWS.features, ACTION_WINDOWS, pairs)
    xte = pipeline.build_features(b, ORDER_WINDOWS.features, ACTION_WINDOWS, pairs)
    ytr = labels.build_labels(b.user, enrich.order_with_category(b), TRAIN_WINDOWS.label_begin, TRAIN_WINDOWS.label_end)
    cols = [c for c in xtr.columns if c != "user_id"]
    return b, xtr.join(ytr, "user_id"), xte, cols


@query("m3_prepare_matrix")
def m3_prepare_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the feature matrix of X5 with a sentinel for NULLs and missing indicators."""
    f = x5_build_features(spark, sf_dir)
    return models.prepare_matrix(f, [c for c in f.columns if c != "user_id"])


@query("w4_folds")
def w4_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled folds (k = 5) and folds stratified by the label, exactly balanced."""
    b = retail.retail_from_testdata(spark, sf_dir)
    y = labels.build_labels(b.user, enrich.order_with_category(b), LABEL.label_begin, LABEL.label_end)
    y = models.exact_folds(y, 5)
    return models.exact_folds(y, 5, stratify="has_order", name="strat_fold")


@query("x11_two_target_gbt")
def x11_two_target_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 refactored: one boosted-tree regression per label (order count, first-order day), all users."""
    b, train, test, cols = _ml_frames(spark, sf_dir)
    pred, _ = models.train_predict_two_target(train, test, cols)
    return pred


@query("x11_baseline_gbt")
def x11_baseline_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 baseline: count label weighted by the regularity weight (X8), date model on buyers only."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    # one set of column names for both periods: the window labels (1/3/6) are relative
    train = pipeline.build_baseline_features(b, TRAIN_WINDOWS.features, TRAIN_WINDOWS.label_begin, TRAIN_WINDOWS.label_end,
                                             ACTION_WINDOWS, True, pairs)
    test = pipeline.build_baseline_features(b, ORDER_WINDOWS.features, LABEL.label_begin, LABEL.label_end,
                                            ACTION_WINDOWS, False, pairs)
    count, first = "Label_30_101_BuyNum", "Label_30_101_FirstTime"
    cols = [c for c in train.columns if c not in ("user_id", count, first)]
    train = train.withColumn("confidence", ranking.regularity_weight(train)).withColumn("has_order", F.col(count) > 0)
    pred, _ = models.train_predict_two_target(train, test, cols, count_label=count, date_label=first,
                                              count_weight="confidence", date_only_buyers="has_order")
    return pred.select("user_id", F.col(count).alias("order_num"), F.col(first).alias("pred_date"))


@query("x18_feature_importance")
def x18_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits and gain of every feature in the models of both labels, most used first."""
    b, train, test, cols = _ml_frames(spark, sf_dir)
    targets = {x: (F.col(x), None) for x in ("order_num", "pred_date")}
    return models.feature_importance(spark, models.fit_targets(train, cols, targets), list(targets))


@query("x12_stacked_bagged")
def x12_stacked_bagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold stacking + 3 bagged models, stopped after 25 rounds without improvement."""
    b, train, test, cols = _ml_frames(spark, sf_dir)
    return models.stacked_bagged_regressor(train, test, cols, "order_num", k=5, bags=3, patience=25)


@query("x13_per_label_forest")
def x13_per_label_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One random forest for all prototype labels, trained on the previous month."""
    b, sku, osc = _proto(spark, sf_dir)
    tr_f = prototype.prototype_features(b.action, osc, sku, date(2000, 7, 1), date(2000, 12, 31), PROTO_GROUPS)
    tr_y = prototype.prototype_labels(osc, sku, date(2001, 1, 1), date(2001, 1, 31), tr_f, PROTO_GROUPS)
    te_f = prototype.prototype_features(b.action, osc, sku, *PROTO_FEATURE, PROTO_GROUPS)
    cols = [c for c in tr_f.columns if c != "user_id"]
    tr_y = tr_y.select("user_id", *[F.col(c).alias(f"y_{c}") for c in tr_y.columns if c != "user_id"])
    ycols = [c for c in tr_y.columns if c != "user_id"]
    return models.per_label_forest(tr_f.join(tr_y, "user_id"), te_f, cols, ycols)


@query("x17_holdout_validation")
def x17_holdout_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on January 2001, predict February 2001, score against February's first orders."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    return models.holdout_validation(b, LABEL.label_begin, action_windows=ACTION_WINDOWS, pair_sources=pairs)


# --- sources and sinks as round trips, flows as queries, ranges of model results

@query("s1_retail_csv")
def s1_retail_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: rows and column sums of the five tables, written as CSV and read back."""
    folder = shared_path(spark, "csv-files")
    retail.write_retail_csv(retail.retail_from_testdata(spark, sf_dir), folder, "t_")
    b = retail.read_retail_csv(spark, folder, "t_")
    sums = {"user": ("user_id", "age", None), "sku": ("sku_id", "cate", None), "action": ("user_id", "a_num", "a_date"),
            "comment": ("o_id", "score_level", "comment_create_tm"), "order": ("o_id", "o_sku_num", "o_date")}
    out = []
    for name, (key, number, day) in sums.items():
        days = F.sum(F.unix_date(F.to_date(day))) if day else F.lit(0)
        out.append(getattr(b, name).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("keys"), F.sum(number).cast("long").alias("numbers"),
                                        days.cast("long").alias("days")).select(F.lit(name).alias("tbl"), "*"))
    return reduce(DataFrame.unionByName, out)


@query("s2_rejected_rows")
def s2_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 with planted faults in the order file: rows per reason, good ones with an empty reason."""
    folder = shared_path(spark, "csv-faults")
    b = retail.retail_from_testdata(spark, sf_dir)
    retail.write_retail_csv(b, folder)
    kind = F.pmod(F.col("o_id"), F.lit(50))
    number = F.col("o_sku_num").cast("string")
    broken = b.order.select(
        "user_id", "sku_id", "o_id", F.when(kind == 1, F.lit("2001-02-30")).otherwise(F.col("o_date").cast("string")).alias("o_date"), "o_area",
        F.when(kind == 2, F.concat(number, F.lit(",9"))).when(kind == 3, F.lit("many")).otherwise(number).alias("o_sku_num"))
    broken.write.option("header", True).option("quote", "\u0000").csv(f"{folder}/broken.csv")
    loaded = retail.load_retail_csv(spark, folder, files={"order": "broken.csv"})
    good = spark.createDataFrame([("", loaded.counts["order"][0])], "reason string, n long")
    return loaded.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(good)


@query("s3_edges_tsv")
def s3_edges_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the edges, written as tab-separated lines and read back."""
    path = shared_path(spark, "edges")
    edges_src.write_edges_tsv(_edges(spark, sf_dir), path)
    return edges_src.read_edges_tsv(spark, path)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written list with their place over the part files in name order (the list is short)."""
    lines = sinks.read_submission(spark, path).select("*", F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_i"))
    return lines.select("user_id", "pred_date", F.row_number().over(W.orderBy("_f", "_i")).cast("long").alias("place"))


@query("s4_submission_file")
def s4_submission_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked list, written and read back, with the place of every line."""
    path = shared_path(spark, "submission")
    sinks.write_submission(x9_submission_refactored(spark, sf_dir), path)
    return _listed(spark, path)


@query("s6_rank_vector")
def s6_rank_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks after 10 updates, written and read back."""
    path = shared_path(spark, "ranks")
    sinks.write_ranks(graph.pagerank(_edges(spark, sf_dir), rtol=None, max_iter=PR_FIXED_ITER), path)
    return sinks.read_ranks(spark, path).select("id", F.round("rank", 10).alias("rank"))


@query("s7_top_rank_lines")
def s7_top_rank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the 100 highest ranks after 10 updates, read back."""
    path = shared_path(spark, "top-ranks")
    sinks.write_top_ranks(graph.pagerank(_edges(spark, sf_dir), rtol=None, max_iter=PR_FIXED_ITER), path, 100)
    return rounded(sinks.read_top_ranks(spark, path))


FEW_ROUNDS = 5  # of the model in x17_score_range, which checks a score's shape; all other queries take all rounds


def _list_facts(spark: SparkSession, b, path: str, last: date) -> DataFrame:
    """One row on a flow's written list: its length, and whether its users are known and met once and its dates end in time."""
    got = _listed(spark, path).join(_users(b).withColumn("_known", F.lit(True)), "user_id", "left")
    return got.agg(F.count(F.lit(1)).alias("listed"), F.count("_known").alias("known"), F.countDistinct("user_id").alias("users"),
                   F.coalesce(F.max("pred_date") <= F.lit(last), F.lit(True)).alias("in_time"))


@query("p_baseline_flow")
def p_baseline_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: baseline flow from the tables to the written list, by model output."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    out = shared_path(spark, "baseline-list")
    flows.run_baseline(b, LABEL.label_begin, BASELINE_CAP, action_windows=ACTION_WINDOWS, pair_sources=pairs, out=out)
    return _list_facts(spark, b, out, BASELINE_CAP)


@query("p_refactored_flow")
def p_refactored_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P' + S5: refactored flow from the tables to the list written under a name with the time."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    out, now = shared_path(spark, "refactored-list"), datetime(2001, 2, 1, 9, 7)
    flows.run_refactored(b, LABEL.label_begin, action_windows=ACTION_WINDOWS, pair_sources=pairs, out=out, now=now)
    return _list_facts(spark, b, f"{out}_0201_0907.csv", date(2001, 3, 31))


@query("p0_prototype_flow")
def p0_prototype_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype flow over three stacked cutoffs; only users with a valid day are listed, so the length is not stated."""
    b = retail.retail_from_testdata(spark, sf_dir)
    out, now = shared_path(spark, "prototype-list"), datetime(2001, 2, 1, 9, 7)
    flows.run_prototype(b, [date(2000, 11, 1), date(2000, 12, 1), date(2001, 1, 1)], LABEL.label_begin, PROTO_GROUPS, TOP_N, out=out, now=now)
    facts = _list_facts(spark, b, f"{out}_0201_0907.csv", date(2001, 2, 14))
    return facts.select((F.col("listed") <= TOP_N).alias("short"), (F.col("listed") == F.col("known")).alias("known"),
                        (F.col("listed") == F.col("users")).alias("once"), "in_time")


@query("x11_prediction_range")
def x11_prediction_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: every user gets both predictions, inside the labels' range widened by a tenth."""
    b, train, test, cols = _ml_frames(spark, sf_dir)
    names = ("order_num", "pred_date")
    train = read_back(train, shared_path(spark, "train-frame"))  # for the labels' range and the fit
    top = train.agg(*[f(x).alias(f"{k}_{x}") for x in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
    pred, _ = models.train_predict_two_target(train, test, cols)
    span = {x: 0.1 * (top[f"hi_{x}"] - top[f"lo_{x}"]) for x in names}
    return pred.select("user_id", *[F.col(x).between(top[f"lo_{x}"] - span[x], top[f"hi_{x}"] + span[x]).alias(f"{x}_in_range") for x in names])


@query("x13_label_range")
def x13_label_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user of the features gets every label, from -1 (none) to the last day or any count."""
    pred = x13_per_label_forest(spark, sf_dir)
    days, nums = ([c for c in pred.columns if c.startswith(f"y_{k}")] for k in ("pred_date", "order_num"))
    return pred.select("user_id", reduce(Column.__and__, [F.col(c).between(-1, 30) for c in days]).alias("days_in_range"),
                       reduce(Column.__and__, [(F.col(c) == -1) | (F.col(c) > 0) for c in nums]).alias("counts_in_range"))


@query("x17_score_range")
def x17_score_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hold-out score of a short fit lies in [0, 1] and blends its two parts."""
    b, pairs = _shared(spark, sf_dir, TRAIN_WINDOWS.features[-1].begin, LABEL.label_end)
    s = models.holdout_validation(b, LABEL.label_begin, action_windows=ACTION_WINDOWS, pair_sources=pairs, rounds=FEW_ROUNDS)
    return s.select(*[F.col(c).between(0, 1).alias(f"{c}_in_range") for c in ("s1", "s2", "s")],
                    (F.abs(F.col("s") - 0.4 * F.col("s1") - 0.6 * F.col("s2")) < 1e-9).alias("blend"))


@query("x18_feature_list")
def x18_feature_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of X5 is listed for both models, used ones with a gain and most used first."""
    b, train, test, cols = _ml_frames(spark, sf_dir)
    targets = {x: (F.col(x), None) for x in ("order_num", "pred_date")}
    got = models.feature_importance(spark, models.fit_targets(train, cols, targets), list(targets))
    return got.select("model", "name", ((F.col("splits") > 0) == (F.col("gain") > 0)).alias("gain_where_used"))
