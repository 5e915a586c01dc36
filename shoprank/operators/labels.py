"""Labels, ground truth and stacking of periods."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import cate_groups, in_window
from ..plans.windows import Win
from .user_agg import Agg, user_window_agg

G = "30_101"


def label_aggregates(order_fact: DataFrame, begin: date, end: date) -> DataFrame:
    """A40 + A41: per user with target-group orders in ``[begin, end]``.

    ``order_num`` = distinct orders, ``pred_date`` = day offset of the first
    order from ``begin`` (the sort + keep-first of the reference is a ``min``).
    Runs on the windowed aggregation engine, whose first level is keyed by
    (user, order), so a user with a very large number of orders is spread
    over many reducers before being counted.
    """
    w = Win("L", begin, end)
    fact = order_fact.withColumn("_offset", F.datediff(F.col("o_date"), F.lit(begin)))
    specs = [Agg("order_num", "nunique", "o_id", G, "L"), Agg("pred_date", "min", "_offset", G, "L")]
    preds = {name: g.predicate for name, g in cate_groups().items() if name != "all"}
    out = user_window_agg(fact, specs, (w,), preds, "o_date")
    return out.where(F.col("order_num").isNotNull()).select(
        "user_id", F.col("order_num").cast("long").alias("order_num"), F.col("pred_date").cast("long").alias("pred_date"))


def build_labels(users: DataFrame, order_fact: DataFrame, begin: date, end: date) -> DataFrame:
    """X6 (refactored names): one row per user, labels 0-filled.

    ``has_order`` tells "no order" apart from "ordered on day 0" (D10).
    """
    lab = label_aggregates(order_fact, begin, end)
    return users.select("user_id").join(lab, "user_id", "left").select(
        "user_id",
        F.coalesce(F.col("order_num"), F.lit(0)).cast("long").alias("order_num"),
        F.coalesce(F.col("pred_date"), F.lit(0)).cast("long").alias("pred_date"),
        F.col("order_num").isNotNull().alias("has_order"),
    )


def build_baseline_labels(users: DataFrame, order_fact: DataFrame, begin: date, end: date) -> DataFrame:
    """X6 (baseline names): user attributes plus the two 0-filled labels.

    Only the labels are filled (D6); user attributes keep their NULLs.
    """
    lab = label_aggregates(order_fact, begin, end)
    return users.join(lab, "user_id", "left").select(
        *[F.col(c) for c in users.columns],
        F.coalesce(F.col("order_num"), F.lit(0)).cast("long").alias("Label_30_101_BuyNum"),
        F.coalesce(F.col("pred_date"), F.lit(0)).cast("long").alias("Label_30_101_FirstTime"),
    )


def inference_labels(users: DataFrame) -> DataFrame:
    """Placeholder labels (-1) for the prediction period; a new frame."""
    return users.select(*users.columns,
                        F.lit(-1).cast("long").alias("Label_30_101_BuyNum"),
                        F.lit(-1).cast("long").alias("Label_30_101_FirstTime"))


def ground_truth(order_fact: DataFrame, begin: date, end: date, group: str | None = None) -> DataFrame:
    """First order date per user in ``[begin, end]``; no category filter by default."""
    rows = order_fact.where(in_window("o_date", begin, end) & F.col("user_id").isNotNull())
    if group is not None:
        rows = rows.where(cate_groups()[group].predicate)
    return rows.groupBy("user_id").agg(F.min("o_date").alias("order_date"))


def stack_periods(frames: list[tuple[date, DataFrame]]) -> DataFrame:
    """Stack per-period frames with a ``cutoff`` column (``unionByName``)."""
    out = None
    for cutoff, df in frames:
        part = df.withColumn("cutoff", F.lit(cutoff))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
