"""Fact enrichment: dimension joins, derived columns, banding.

Dimension joins carry no broadcast hint: Spark broadcasts a dimension only
when its measured size is below ``spark.sql.autoBroadcastJoinThreshold``
(statically, or at run time through AQE) and falls back to a shuffled join
beyond it, so a dimension that grows with the data never floods executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import to_midnight
from ..functions.predicates import recode_category
from ..schema import RetailBundle
from .rangerank import exact_quantiles

MISSING_SCORE = -1
QUINTILES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)


def with_date_parts(df: DataFrame, date_col: str, names=("year", "month", "day")) -> DataFrame:
    """add year, month and day-of-month of ``date_col``."""
    c = F.col(date_col)
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    out = df
    for part, name in zip(("year", "month", "day"), names):
        if name:
            out = out.withColumn(name, fns[part](c))
    return out


def line_total(price: str = "price", qty: str = "o_sku_num") -> Column:
    """``price * quantity``."""
    return F.col(price) * F.col(qty)


def enrich_orders(b: RetailBundle) -> DataFrame:
    """Order lines with their comments, user attributes and sku attributes.

    Left joins on ``(user_id, o_id)``, ``user_id`` and ``sku_id``; an order with
    several comments fans out, one row per comment, as in the source. Adds
    ``total_price`` (F12) and the date parts of ``o_date`` (F11).
    """
    out = (
        b.order.join(b.comment, ["user_id", "o_id"], "left")
        .join(b.user, "user_id", "left")
        .join(b.sku, "sku_id", "left")
        .withColumn("total_price", line_total())
    )
    return with_date_parts(out, "o_date")


def enrich_actions(b: RetailBundle) -> DataFrame:
    """Actions with user and sku attributes, plus date parts of ``a_date``."""
    out = b.action.join(b.user, "user_id", "left").join(b.sku, "sku_id", "left")
    return with_date_parts(out, "a_date")


def sku_category(sku: DataFrame) -> DataFrame:
    """The distinct ``(sku_id, cate)`` dimension."""
    return sku.select("sku_id", "cate").distinct()


def sku_price(sku: DataFrame) -> DataFrame:
    """The distinct ``(sku_id, price)`` dimension (fans out on two prices)."""
    return sku.select("sku_id", "price").distinct()


def attach_score(order: DataFrame, comment: DataFrame) -> DataFrame:
    """Left join the score on ``(o_id, user_id)``; a missing score is -1.

    Only the score column gets the default (D8), so an unknown category stays
    NULL and is still counted in ``others`` by the null-safe predicate.
    """
    score = comment.select("o_id", "user_id", "score_level")
    return (order.join(score, ["o_id", "user_id"], "left")
            .withColumn("score_level", F.coalesce(F.col("score_level"), F.lit(MISSING_SCORE)).cast("int")))


def order_fact(b: RetailBundle) -> DataFrame:
    """Order fact of the refactored pipeline.

    Columns: user_id, sku_id, o_id, o_date, o_area, o_sku_num, cate,
    score_level, o_month, o_day, o_total_price.
    """
    o = b.order.join(sku_category(b.sku), "sku_id", "left")
    o = attach_score(o, b.comment)
    o = o.join(sku_price(b.sku), "sku_id", "left")
    o = with_date_parts(o, "o_date", names=(None, "o_month", "o_day"))
    o = o.withColumn("o_total_price", line_total("price", "o_sku_num")).drop("price")
    return o.select("user_id", "sku_id", "o_id", "o_date", "o_area", "o_sku_num", "cate",
                    "score_level", "o_month", "o_day", "o_total_price")


def order_with_category(b: RetailBundle) -> DataFrame:
    """J3 only: order lines with their category.

    Enough for labels (distinct orders, first day), which no row fan-out of
    the score or price joins can change; it saves those two joins.
    """
    return b.order.join(sku_category(b.sku), "sku_id", "left")


def action_fact(b: RetailBundle) -> DataFrame:
    """Action fact of the refactored pipeline (J3, F11): action + cate + month/day."""
    a = b.action.join(sku_category(b.sku), "sku_id", "left")
    a = with_date_parts(a, "a_date", names=(None, "a_month", "a_day"))
    return a.select("user_id", "sku_id", "a_date", "a_num", "a_type", "cate", "a_month", "a_day")


def prototype_order_scores(order: DataFrame, comment: DataFrame) -> DataFrame:
    """J6 + F7 + F13: the prototype's order table with scores, in weighted form.

    The prototype re-attaches scores on ``(user_id, sku_id, o_date)``, so m
    order lines and n scored lines of one user, sku and day give m x n rows.
    Rather than emitting those pairs, both sides are counted at that grain
    and joined once: each output row carries ``weight`` = the number of rows
    the pair expansion would have produced for its score (m x n, or m with
    score -1 when the key has no score). Row counts downstream are sums of
    ``weight``.
    """
    o = order.select("user_id", "sku_id", "o_id", "o_date")
    lines = o.groupBy("user_id", "sku_id", "o_date").agg(F.count(F.lit(1)).alias("m"))
    c = comment.select("o_id", "user_id", to_midnight("comment_create_tm").alias("c_date"), "score_level")
    scored = (o.join(c, ["o_id", "user_id"], "inner")
              .where(F.col("score_level").isNotNull())
              .groupBy("user_id", "sku_id", "o_date", "score_level")
              .agg(F.count(F.lit(1)).alias("n")))
    j = lines.join(scored, ["user_id", "sku_id", "o_date"], "left")
    return j.select(
        "user_id", "sku_id", "o_date",
        F.coalesce(F.col("score_level"), F.lit(MISSING_SCORE)).cast("int").alias("score_level"),
        (F.col("m") * F.coalesce(F.col("n"), F.lit(1))).cast("long").alias("weight"),
    )


def quintile_edges(df: DataFrame, cols: list[str], approx: bool = False, accuracy: int = 10000) -> dict[str, Column]:
    """Bin edges at 0, 20, ..., 100 % of each column as an array literal.

    The exact form interpolates linearly like ``pandas.qcut``; all columns are
    counted in one pass (see ``exact_quantiles``). ``approx=True`` uses a
    bounded sketch per column instead.
    """
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(QUINTILES), accuracy).alias(c) for c in cols]).first()
        found = {c: row[c] for c in cols}
    else:
        both = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x"))
        found = exact_quantiles(both.select("x.c", "x.v"), "c", "v", list(QUINTILES))
    none = [None] * len(QUINTILES)
    return {c: F.array(*[F.lit(x).cast("double") for x in found.get(c) or none]) for c in cols}


def quintile_band(x: Column, edges: Column) -> Column:
    """band index 0-4; a value on an inner edge goes to the lower band.

    Computed from the original value, never from a partly rewritten column (D7).
    """
    x = x.cast("double")
    return (F.when(x.isNull(), F.lit(None))
            .when(x <= edges[1], 0).when(x <= edges[2], 1).when(x <= edges[3], 2)
            .when(x <= edges[4], 3).otherwise(4).cast("int"))


def prototype_skus(sku: DataFrame, approx: bool = False) -> DataFrame:
    """F9 + F10: recoded category and quintile bands of ``price`` and ``para_1``."""
    edges = quintile_edges(sku, ["price", "para_1"], approx)
    return sku.select(
        "sku_id",
        quintile_band(F.col("price"), edges["price"]).alias("price"),
        recode_category("cate").alias("cate"),
        quintile_band(F.col("para_1"), edges["para_1"]).alias("para_1"),
        "para_2", "para_3",
    )
