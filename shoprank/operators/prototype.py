"""The prototype pipeline: group totals, labels and user alignment.

Groups are sku memberships (F3): ``30``, ``101``, ``tg`` (either target),
``ntg`` (any other, unknown category included) on the recoded category of
:func:`~shoprank.operators.enrich.prototype_skus`. Membership comes from one
join with the sku table, never from collected id lists.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import in_window, is_star, is_view, prototype_groups, score_bad, score_good

ALL_GROUPS = ("30", "101", "tg", "ntg")


def _check(cate_types) -> dict[str, Column]:
    groups = prototype_groups("cate_code")
    bad = [c for c in cate_types if c not in groups]
    if bad:  # D9: validate the argument, not the list against itself
        raise ValueError(f"unknown category types {bad}")
    return {c: groups[c] for c in cate_types}


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def prototype_features(action: DataFrame, order_scores: DataFrame, proto_sku: DataFrame,
                       begin: date, end: date, cate_types=("tg",)) -> DataFrame:
    """X7 features: view/star totals (A37) and order/good/bad counts (A38) per group.

    Users appear if they viewed or starred, or ordered, in a chosen group; the
    two sides are merged with a full outer join and absent values are 0 (J8).
    ``order_scores`` is the weighted output of
    :func:`~shoprank.operators.enrich.prototype_order_scores`.
    """
    groups = _check(cate_types)
    cat = proto_sku.select("sku_id", F.col("cate").alias("cate_code"))
    a = action.where(in_window("a_date", begin, end)).join(cat, "sku_id", "inner")
    a = a.where((is_view() | is_star()) & _any(list(groups.values())))
    acols = []
    for name, g in groups.items():
        acols += [F.sum(F.when(g & is_view(), F.col("a_num"))).alias(f"view_num_{name}"),
                  F.sum(F.when(g & is_star(), F.col("a_num"))).alias(f"star_num_{name}")]
    af = a.groupBy("user_id").agg(*acols)

    o = order_scores.where(in_window("o_date", begin, end)).join(cat, "sku_id", "inner")
    o = o.where(_any(list(groups.values())))
    ocols = []
    for name, g in groups.items():
        w = F.col("weight")
        ocols += [F.sum(F.when(g, w)).alias(f"order_num_{name}"),
                  F.sum(F.when(g & score_good(), w)).alias(f"good_score_num_{name}"),
                  F.sum(F.when(g & score_bad(), w)).alias(f"bad_score_num_{name}")]
    of = o.groupBy("user_id").agg(*ocols)

    j = af.join(of, "user_id", "full_outer")
    value_cols = [c for c in af.columns if c != "user_id"] + [c for c in of.columns if c != "user_id"]
    return j.select("user_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in value_cols])


def prototype_label_aggregates(order_scores: DataFrame, proto_sku: DataFrame, begin: date, end: date,
                               cate_types=("tg",)) -> DataFrame:
    """Per group, the first order day offset and the order row count; -1 when absent."""
    groups = _check(cate_types)
    cat = proto_sku.select("sku_id", F.col("cate").alias("cate_code"))
    o = order_scores.where(in_window("o_date", begin, end)).join(cat, "sku_id", "inner")
    o = o.where(_any(list(groups.values())))
    off = F.datediff(F.col("o_date"), F.lit(begin))
    cols = []
    for name, g in groups.items():
        cols += [F.min(F.when(g, off)).alias(f"pred_date_{name}"),
                 F.sum(F.when(g, F.col("weight"))).alias(f"order_num_{name}")]
    lab = o.groupBy("user_id").agg(*cols)
    return lab.select("user_id", *[F.coalesce(F.col(c), F.lit(-1)).cast("long").alias(c)
                                   for c in lab.columns if c != "user_id"])


def prototype_labels(order_scores: DataFrame, proto_sku: DataFrame, begin: date, end: date,
                     feature_users: DataFrame, cate_types=("tg",)) -> DataFrame:
    """X7 labels aligned to the feature users: J10 + J11 collapsed into one left join, -1 fill."""
    lab = prototype_label_aggregates(order_scores, proto_sku, begin, end, cate_types)
    cols = [c for c in lab.columns if c != "user_id"]
    return (feature_users.select("user_id").distinct().join(lab, "user_id", "left")
            .select("user_id", *[F.coalesce(F.col(c), F.lit(-1)).cast("long").alias(c) for c in cols]))


def align_to_users(labels: DataFrame, feature_users: DataFrame, fill: int = -1) -> DataFrame:
    """J10 semi join + J11 anti join + U2 append, in the reference's explicit form.

    Keeps label rows of users that have features, then appends the feature
    users without a label row with every label column set to ``fill``.
    """
    fu = feature_users.select("user_id").distinct()
    kept = labels.join(fu, "user_id", "left_semi")
    missing = fu.join(labels.select("user_id"), "user_id", "left_anti")
    cols = [c for c in labels.columns if c != "user_id"]
    missing = missing.select("user_id", *[F.lit(fill).cast(labels.schema[c].dataType).alias(c) for c in cols])
    return kept.unionByName(missing)
