"""Declared schemas and the retail dataset bundle.

Every source is read with a fixed schema (no inference), so a 100 TB scan
never runs an extra pass to guess types.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("sex", T.IntegerType()),
    T.StructField("user_lv_cd", T.IntegerType()),
])

SKU_SCHEMA = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("cate", T.IntegerType()),
    T.StructField("para_1", T.IntegerType()),
    T.StructField("para_2", T.IntegerType()),
    T.StructField("para_3", T.IntegerType()),
])

ACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("a_date", T.DateType()),
    T.StructField("a_num", T.IntegerType()),
    T.StructField("a_type", T.IntegerType()),
])

ORDER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("o_id", T.LongType()),
    T.StructField("o_date", T.DateType()),
    T.StructField("o_area", T.IntegerType()),
    T.StructField("o_sku_num", T.IntegerType()),
])

COMMENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("comment_create_tm", T.TimestampNTZType()),
    T.StructField("o_id", T.LongType()),
    T.StructField("score_level", T.IntegerType()),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
])

TRUTH_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("pred_date", T.DateType()),
    T.StructField("rank", T.LongType()),
])

RANKS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("rank", T.DoubleType()),
])


@dataclass(frozen=True)
class RetailBundle:
    """The five retail tables as lazy DataFrames."""

    user: DataFrame
    sku: DataFrame
    action: DataFrame
    order: DataFrame
    comment: DataFrame

    def with_(self, **kw) -> "RetailBundle":
        return replace(self, **kw)
