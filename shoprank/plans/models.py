"""Model jobs: matrix preparation, boosted trees, stacking and bagging, a forest, folds.

Training data is one row per user. Trees are grown by passes over a binned
matrix in the shared folder (``operators.trees``); the driver holds trees,
bin edges and histogram sums, never rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, labels, ranking, scoring, trees
from ..operators.rangerank import with_rank
from ..operators.trees import TRAIN, VALIDATION
from ..plans import pipeline
from ..plans.windows import feature_windows
from ..schema import RetailBundle
from ..session import read_back, remove_path, shared_path

SENTINEL = -999.0
SEED = 2018

# The reference's booster settings (100 rounds unless stopped, learning rate 0.05, 0.9 of the features per tree,
# 0.8 of the rows drawn anew every 5 trees, 20 rows in a leaf at least; stacked and bagged models stop after 200 rounds without
# improvement, 10,000 at most). Trees grow level by level to 32 leaves, where the reference grows 31 leaf by leaf.
ROUNDS, RATE = 100, 0.05
MOST_ROUNDS, PATIENCE = 10_000, 200


def prepare_matrix(df: DataFrame, cols: list[str], sentinel: float = SENTINEL, indicators: bool = True) -> DataFrame:
    """M3: numeric matrix without NULLs: sentinel fill plus ``<col>_missing`` flags.

    For learners that do not route missing values. The trees used here read
    the columns themselves, NULLs included, and learn the side of a split
    that missing values take.
    """
    out = [F.col("user_id")]
    for c in cols:
        out.append(F.coalesce(F.col(c).cast("double"), F.lit(sentinel)).alias(c))
        if indicators:
            out.append(F.col(c).isNull().cast("int").alias(f"{c}_missing"))
    keep = [c for c in df.columns if c not in cols and c != "user_id"]
    return df.select(*out, *keep)


def matrix_columns(cols: list[str], indicators: bool = True) -> list[str]:
    return [x for c in cols for x in ([c, f"{c}_missing"] if indicators else [c])]


def exact_folds(df: DataFrame, k: int, seed: int = SEED, stratify: str | None = None, name: str = "fold", path: str | None = None) -> DataFrame:
    """Shuffled folds whose sizes differ by one at most, in every stratum.

    Rows are ordered by the md5 of ``seed:user_id`` within their stratum and
    dealt out in turn; the ranks come from range partitions, so no stratum is
    one task's window (D11: the order depends on seed and id alone).
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id").cast("string")).cast("binary"))
    ranked = with_rank(df.withColumn("_order", order), ["_order", "user_id"], [stratify] if stratify else [], "_rank", path)
    return ranked.withColumn(name, (F.col("_rank") % k).cast("int")).drop("_order", "_rank")


def fit_targets(train: DataFrame, cols: list[str], targets: dict[str, tuple[Column, str | None]], rounds: int = ROUNDS,
                rate: float = RATE, **kw) -> trees.Ensemble:
    """One boosted-tree model per target, grown side by side: its label, and the boolean column that restricts its rows (or None)."""
    y = [label for label, _ in targets.values()]
    role = [F.when(F.coalesce(F.col(only), F.lit(False)) if only else F.lit(True), TRAIN).otherwise(0) for _, only in targets.values()]
    return trees.boost(train, cols, y, role, rounds=rounds, rate=rate, **kw)


def train_predict_two_target(train: DataFrame, test: DataFrame, cols: list[str],
                             count_label: str = "order_num", date_label: str = "pred_date",
                             count_weight: str | None = None, date_only_buyers: str | None = None,
                             **kw) -> tuple[DataFrame, trees.Ensemble]:
    """X11: one squared-error boosted-tree regression per label, predictions for ``test``.

    ``count_weight`` multiplies the count label (the baseline's regularity
    weight, X8); ``date_only_buyers`` names a boolean column restricting the
    date model to users who bought (baseline, with D10's ``has_order``).
    Both models grow in the same passes and score one frame: no join.
    """
    y = F.col(count_label) * F.col(count_weight) if count_weight else F.col(count_label)
    targets = {count_label: (y, None), date_label: (F.col(date_label), date_only_buyers)}
    model = fit_targets(train, cols, targets, **kw)
    return trees.with_predictions(test, model, list(targets), ["user_id"]), model


def stacked_bagged_regressor(train: DataFrame, test: DataFrame, cols: list[str], label: str, k: int = 5, bags: int = 3,
                             holdout: float = 0.33, rounds: int = MOST_ROUNDS, patience: int = PATIENCE, **kw) -> DataFrame:
    """K-fold stacking, then bagging, both with early stopping; returns ``(user_id, prediction)``.

    Stage 1 fits one model per fold on the other folds, with the held-out
    fold as its validation set, and takes its prediction there as the row's
    stack feature; the test feature is the mean of the fold models. Folds are
    stratified by the label. Stage 2 fits ``bags`` models, each with a
    hash-chosen part as validation set, and averages them. All models of a
    stage grow in the same passes, and a model that has stopped costs nothing
    more. The rows of both frames go through as one table, without joins.
    """
    spark = train.sparkSession
    both = train.select("user_id", *cols, F.col(label).cast("double").alias("_y"), F.lit(True).alias("_train")).unionByName(
        test.select("user_id", *cols, F.lit(None).cast("double").alias("_y"), F.lit(False).alias("_train")))
    paths = {x: shared_path(spark, f"stack-{x}") for x in ("rows", "folds", "stacked")}
    try:
        rows = read_back(both, paths["rows"])
        if k > 1:
            rows = exact_folds(rows.withColumn("_s", F.col("_y")), k, stratify="_s", name="_fold", path=paths["folds"])
            role = [F.when(F.col("_train"), F.when(F.col("_fold") == f, VALIDATION).otherwise(TRAIN)).otherwise(0) for f in range(k)]
            first = trees.boost(rows, cols, [F.col("_y")] * k, role, rounds=rounds, patience=patience, **kw)
            names = [f"_p{f}" for f in range(k)]
            scored = trees.with_predictions(rows, first, names)
            own = F.element_at(F.array(*[F.col(x) for x in names]), F.col("_fold") + 1)
            mean = sum((F.col(x) for x in names[1:]), F.col(names[0])) / F.lit(k)
            rows = read_back(scored.withColumn("stack", F.when(F.col("_train"), own).otherwise(mean)).drop("_s", "_fold", *names), paths["stacked"])
            cols = [*cols, "stack"]
        share = [F.pmod(F.xxhash64("user_id", F.lit(SEED + b), F.lit("bag")), F.lit(10_000)) for b in range(bags)]
        role = [F.when(F.col("_train"), F.when(x < int(holdout * 10_000), VALIDATION).otherwise(TRAIN)).otherwise(0) for x in share]
        second = trees.boost(rows, cols, [F.col("_y")] * bags, role, rounds=rounds, patience=patience, **kw)
        names = [f"_p{b}" for b in range(bags)]
        out = trees.with_predictions(rows.where(~F.col("_train")), second, names, ["user_id"])
        mean = sum((F.col(x) for x in names[1:]), F.col(names[0])) / F.lit(bags)
        return read_back(out.select("user_id", mean.alias("prediction")), shared_path(spark, "stack-predictions"))
    finally:
        for p in paths.values():
            remove_path(spark, p)


def per_label_forest(train: DataFrame, test: DataFrame, cols: list[str], label_cols: list[str], num_trees: int = 10,
                     shape: trees.Shape | None = None) -> DataFrame:
    """One random forest over all label columns together; the classes predicted for ``test``.

    A split lowers the Gini impurity summed over the labels, so all labels
    share their trees; each label gets the class with the largest mean share.
    """
    model = trees.class_forest(train, cols, label_cols, num_trees, shape)
    return trees.with_predictions(test, model, label_cols, ["user_id"])


def feature_importance(spark: SparkSession, model: trees.Ensemble, names: list[str]) -> DataFrame:
    """``(model, name, splits, gain)`` of every feature, by number of splits (the reference's importance)."""
    return trees.importance(trees.node_table(spark, model, names), model.columns)


def holdout_validation(b: RetailBundle, test_label_begin: date, months=(1, 3, 6), n: int = 50_000,
                       action_windows=None, pair_sources=None, **kw) -> DataFrame:
    """Train on month m-1, predict month m, score against month m's first orders.

    Returns one row ``(s1, s2, s)``.
    """
    test_w = feature_windows(test_label_begin, months)
    train_begin = date(test_label_begin.year - (1 if test_label_begin.month == 1 else 0),
                       12 if test_label_begin.month == 1 else test_label_begin.month - 1, 1)
    train_w = feature_windows(train_begin, months)
    of = enrich.order_with_category(b)
    train_x = pipeline.build_features(b, train_w.features, action_windows, pair_sources)
    test_x = pipeline.build_features(b, test_w.features, action_windows, pair_sources)
    y = labels.build_labels(b.user, of, train_w.label_begin, train_w.label_end)
    cols = [c for c in train_x.columns if c != "user_id"]
    pred, _ = train_predict_two_target(train_x.join(y, "user_id"), test_x, cols, **kw)
    sub = ranking.submission_refactored(pred, test_w.label_begin, n)
    truth = labels.ground_truth(b.order, test_w.label_begin, test_w.label_end)
    return scoring.score(truth, sub)
