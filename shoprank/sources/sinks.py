"""Sinks: submission CSV (S4, S5), rank vectors (S6), top-rank lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RANKS_SCHEMA


def timestamped_name(base: str, now: datetime | None = None, ext: str = ".csv") -> str:
    """``<base>_%m%d_%H%M<ext>``, built on the driver."""
    now = now or datetime.now()
    return f"{base}{now.strftime('_%m%d_%H%M')}{ext}"


def write_submission(pred: DataFrame, path: str) -> None:
    """``user_id,pred_date`` lines in rank order, the header in front.

    Rows are dealt out by ranges of the rank and sorted there, so no task
    writes the whole list; the part files, taken in name order, are the list.
    """
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.date_format("pred_date", "yyyy-MM-dd"))
    head = pred.sparkSession.range(1).select(F.lit(-1).cast("long").alias("rank"), F.lit("user_id,pred_date").alias("value"))
    body = pred.select(F.col("rank").cast("long").alias("rank"), line.alias("value"))
    head.unionByName(body).repartitionByRange("rank").sortWithinPartitions("rank").select("value").write.mode("overwrite").text(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """The list of :func:`write_submission` as ``user_id, pred_date``."""
    lines = spark.read.text(path).where(F.col("value") != "user_id,pred_date")
    parts = F.split("value", ",")
    return lines.select(parts[0].cast("long").alias("user_id"), F.to_date(parts[1]).alias("pred_date"))


def write_ranks(ranks: DataFrame, path: str) -> None:
    """Persist a rank vector ``(id, rank)``."""
    ranks.select("id", "rank").write.mode("overwrite").parquet(path)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Reload a rank vector."""
    return spark.read.schema(RANKS_SCHEMA).parquet(path)


def write_top_ranks(ranks: DataFrame, path: str, n: int = 100) -> None:
    """The top ``n`` nodes as ``id \\t rank`` lines, descending."""
    top = ranks.orderBy(F.desc("rank"), F.asc("id")).limit(n)
    top.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", False).csv(path)


def read_top_ranks(spark: SparkSession, path: str) -> DataFrame:
    """The lines of :func:`write_top_ranks` as ``id, rank``."""
    return spark.read.option("sep", "\t").option("header", False).schema("id long, rank double").csv(path)
