"""Row numbers and exact quantiles per group without a window over a whole group.

Rows are dealt out by range over group and order and written once, with the
number of their partition and their place in it. Only one row per partition
and group is summed up across partitions, so a group that holds most of all
rows is ranked by as many tasks as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import read_back, remove_path, shared_path


def with_rank(df: DataFrame, order: list[str], groups: list[str] | None = None, name: str = "rank", path: str | None = None) -> DataFrame:
    """``df`` with the 0-based number of every row within its group, in ``order`` (ties in any order).

    The sorted rows are written to ``path`` (a new place in the checkpoint
    folder by default), which has to stay while the result is in use.
    """
    groups = groups or []
    path = path or shared_path(df.sparkSession, "ranked")
    rows = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order).withColumn("_at", F.monotonically_increasing_id())
    rows = read_back(rows, path).withColumn("_part", F.shiftright("_at", 33))
    part = rows.groupBy("_part", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_group = W.partitionBy(*[f"_g{i}" for i in range(len(groups))]).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    part = part.withColumnRenamed("_part", "_p").withColumn("_shift", F.coalesce(F.sum("_n").over(of_group), F.lit(0)) - F.col("_first"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(part, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def exact_quantiles(df: DataFrame, group: str, value: str, at: list[float]) -> dict:
    """Exact quantiles of ``value`` per group, linearly interpolated; NULL values do not count.

    One pass counts the values of all groups; the counts are ranked by range
    and only the values at the wanted ranks leave the tasks. The number of
    groups has to be small (the result is a dict on the driver); the written
    counts are deleted.
    """
    spark = df.sparkSession
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    path = shared_path(spark, "quantile-counts")
    try:
        ranged = read_back(counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()), path)
        parts = ranged.groupBy("g", "part").agg(F.sum("n").alias("rows"))
        of_group = W.partitionBy("g")
        parts = parts.select("g", "part", F.sum("rows").over(of_group).alias("total"), F.coalesce(
            F.sum("rows").over(of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        upto = F.col("before") + F.sum("n").over(W.partitionBy("g", "part").orderBy("v"))
        placed = ranged.join(parts, ["g", "part"]).select("g", "v", "n", "total", upto.alias("upto"))

        def value_at(rank):
            return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("v")))

        ranks = [F.lit(q) * (F.col("total") - 1) for q in at]
        cols = [value_at(f(r)) for r in ranks for f in (F.floor, F.ceil)]
        out = {}
        for row in placed.groupBy("g").agg(F.max("total"), *cols).collect():
            g, total, found = row[0], row[1], row[2:]
            share = [q * (total - 1) % 1 for q in at]
            out[g] = [lo + x * (hi - lo) for x, lo, hi in zip(share, found[::2], found[1::2])]
        return out
    finally:
        remove_path(spark, path)
