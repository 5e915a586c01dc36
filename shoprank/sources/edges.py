"""Edge-list sources (S3) and the edge adapter from the synthetic tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EDGE_SCHEMA

#: Order lines that one task of the join takes.
LINES_A_TASK = 500_000


def read_edges_tsv(spark: SparkSession, path: str) -> DataFrame:
    """S3: headerless two-column TSV ``src \\t dst`` with a declared schema."""
    return spark.read.option("sep", "\t").option("header", False).schema(EDGE_SCHEMA).csv(path)


def write_edges_tsv(edges: DataFrame, path: str) -> None:
    """Headerless lines of source, tab, target, as ``read_edges_tsv`` takes them."""
    edges.select("src", "dst").write.option("sep", "\t").option("header", False).csv(path)


def edges_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed edges customer -> part, one per order line, in one id space.

    Parallel edges (a customer buying a part twice) and self-loops (a customer
    key equal to a part key) are kept: the graph operators handle both. The
    join's tasks follow the number of lines, so that what one of them sorts
    and counts does not grow with the input.
    """
    from .retail import _read

    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = math.ceil(li.count() / LINES_A_TASK)
    if tasks > spark.sparkContext.defaultParallelism:  # else the session's partitions hold few lines
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("long").alias("src"), F.col("l_partkey").cast("long").alias("dst")
    )
