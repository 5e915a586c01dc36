"""Link analysis on edge lists.

PageRank is an iterative join + aggregate: each iteration joins the rank of
every source with its out-edges (a bucketed table, never shuffled again), sums
the shares per target, and adds the dangling mass and the teleport term. The
next dangling mass and the convergence test are observed metrics of the
iteration's write (two numbers to the driver, no extra job). Every iteration's
ranks are written as Parquet to the session's checkpoint folder, which cuts
the lineage: a lost executor costs the tasks of one iteration. The ranks
before the last iteration and the edge table are deleted on the way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.mathx import within_tolerance
from ..session import read_back, remove_path, shared_path
from .rangerank import exact_quantiles

# Damping and tolerances of the reference defaults.
DAMPING = 0.85
RTOL = 1e-5
ATOL = 1e-8


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, out_deg, in_deg)`` for every node (parallel edges and self-loops counted).

    Each edge is emitted once as its source and once as its target and the
    counts are summed per node, with map-side partial aggregation.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("e")).select("e.*")
    return ends.groupBy("id").agg(F.sum("o").cast("long").alias("out_deg"), F.sum("i").cast("long").alias("in_deg"))


def all_nodes(edges: DataFrame) -> DataFrame:
    """Distinct nodes of either column; one pass over the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def dead_ends(edges: DataFrame) -> DataFrame:
    """U4: nodes that never appear as a source."""
    return degrees(edges).where(F.col("out_deg") == 0).select("id")


def dead_starts(edges: DataFrame) -> DataFrame:
    """Nodes that never appear as a target."""
    return degrees(edges).where(F.col("in_deg") == 0).select("id")


def graph_counts(edges: DataFrame) -> DataFrame:
    """A44 (+U4/U5 sizes): edges, sources, targets, nodes, dead ends, dead starts in one row."""
    deg = degrees(edges)
    return deg.agg(
        F.sum("out_deg").cast("long").alias("n_edges"),
        F.count(F.when(F.col("out_deg") > 0, 1)).cast("long").alias("n_sources"),
        F.count(F.when(F.col("in_deg") > 0, 1)).cast("long").alias("n_targets"),
        F.count(F.lit(1)).cast("long").alias("n_nodes"),
        F.count(F.when(F.col("out_deg") == 0, 1)).cast("long").alias("n_dead_ends"),
        F.count(F.when(F.col("in_deg") == 0, 1)).cast("long").alias("n_dead_starts"),
    )


def degree_summary(edges: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles, max of out-degree (over sources) and in-degree (over targets).

    Exact quartiles interpolate linearly like ``describe``; the degrees of
    both kinds are ranked over range partitions (``exact_quantiles``).
    """
    deg = degrees(edges)
    rows = deg.select(F.explode(F.array(
        F.struct(F.lit("out").alias("kind"), F.col("out_deg").alias("deg")),
        F.struct(F.lit("in").alias("kind"), F.col("in_deg").alias("deg")),
    )).alias("r")).select("r.*").where(F.col("deg") > 0)
    at = exact_quantiles(rows, "kind", "deg", [0.25, 0.5, 0.75])

    def quartile(i: int) -> Column:
        return F.when(F.col("kind") == "out", F.lit(at.get("out", [None] * 3)[i])).otherwise(F.lit(at.get("in", [None] * 3)[i])).cast("double")

    return rows.groupBy("kind").agg(
        F.count(F.lit(1)).cast("long").alias("count"),
        F.avg("deg").alias("mean"),
        F.stddev_samp("deg").alias("std"),
        F.min("deg").alias("min"),
        F.max("deg").alias("max"),
    ).select("kind", "count", "mean", "std", "min", *[quartile(i).alias(n) for i, n in enumerate(("p25", "p50", "p75"))], "max")


def degree_histogram(edges: DataFrame, width: int = 1, below: dict[str, int] | None = None) -> DataFrame:
    """``(kind, bucket, n)`` distribution of all degrees; ``below`` cuts it at a limit per kind (for a plot)."""
    deg = degrees(edges)
    rows = deg.select(F.explode(F.array(
        F.struct(F.lit("out").alias("kind"), F.col("out_deg").alias("deg")),
        F.struct(F.lit("in").alias("kind"), F.col("in_deg").alias("deg")),
    )).alias("r")).select("r.*").where(F.col("deg") > 0)
    if below:
        cond = None
        for kind, lim in below.items():
            c = (F.col("kind") == kind) & (F.col("deg") < lim)
            cond = c if cond is None else cond | c
        rows = rows.where(cond)
    return rows.groupBy("kind", (F.floor(F.col("deg") / width) * width).cast("long").alias("bucket")).agg(
        F.count(F.lit(1)).cast("long").alias("n"))


def pagerank(edges: DataFrame, p: float = DAMPING, rtol: float | None = RTOL, atol: float = ATOL,
             max_iter: int = 100, partitions: int | None = None, salt_rows: int = 1_000_000) -> DataFrame:
    """PageRank ``(id, rank)`` of every node; ranks sum to 1.

    Self-loops are dropped and not counted in the out-degree; parallel edges
    each carry a share. Nodes without out-weight (dead ends and self-loop-only
    nodes, D12) spread their rank evenly over all nodes. Jacobi update
    ``r' = p * (M r + dangling / N) + (1 - p) / N`` from ``1/N``; stops when
    every node has ``|r' - r| <= atol + rtol * |r|``. Without convergence
    within ``max_iter`` updates it raises; ``rtol=None`` runs exactly
    ``max_iter``.

    Skew: a source with more than ``salt_rows`` distinct out-links is spread
    over ``ceil(links / salt_rows)`` sub-keys by a hash of the target, so no
    task holds more than about ``salt_rows`` links of a source, and only that
    source's rank share is repeated. The salt counts of such sources (at most
    links / ``salt_rows`` rows) are written, so the optimiser knows their size
    when it joins them to the links; a plain join, which adaptive execution
    can split at a hub.
    """
    spark = edges.sparkSession
    if partitions is None:
        conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
        partitions = int(conf) if conf.isdigit() else spark.sparkContext.defaultParallelism
    paths = {k: shared_path(spark, f"pagerank-{k}") for k in ("pairs", "nodes", "salts", "links")}
    table, path = f"shoprank_pagerank_links_{uuid.uuid4().hex}", None
    try:
        # One pass over the edge source: parallel edges are counted per pair
        # (self-loops kept for the node set), and all below reads this result.
        pairs = read_back(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt")), paths["pairs"])
        links = pairs.where(F.col("src") != F.col("dst"))
        ends = pairs.select(F.explode(F.array(
            F.struct(F.col("src").alias("id"), F.when(F.col("src") != F.col("dst"), F.col("cnt")).alias("cnt")),
            F.struct(F.col("dst").alias("id"), F.lit(None).cast("long").alias("cnt")))).alias("e")).select("e.*")
        nodes = ends.groupBy("id").agg(F.sum("cnt").alias("deg"), F.count("cnt").alias("fanout"))
        nsalt = F.greatest(F.lit(1), F.ceil(F.col("fanout") / F.lit(salt_rows))).cast("int")
        nodes = read_back(nodes.select("id", "deg", nsalt.alias("nsalt")), paths["nodes"])
        n = nodes.count()
        if n == 0:
            return spark.createDataFrame([], "id long, rank double")
        salts = read_back(nodes.where(F.col("nsalt") > 1).select(F.col("id").alias("src"), "nsalt"), paths["salts"])
        salted = links.join(salts, "src", "left").select(
            "src", F.pmod(F.xxhash64("dst"), F.coalesce("nsalt", F.lit(1))).cast("int").alias("salt"), "dst", "cnt")
        (salted.repartition(partitions, "src", "salt").write.bucketBy(partitions, "src", "salt").sortBy("src", "salt")
         .option("path", paths["links"]).saveAsTable(table))
        links = spark.table(table)
        ranks = nodes.select("id", "deg", "nsalt", F.lit(1.0 / n).alias("rank"))
        dangling = nodes.where(F.col("deg").isNull()).count() / n
        bad = 0
        for _ in range(max_iter):
            share = ranks.where(F.col("deg").isNotNull()).select(
                F.col("id").alias("src"), (F.col("rank") / F.col("deg")).alias("share"),
                F.explode(F.sequence(F.lit(0), F.col("nsalt") - 1)).alias("salt"))
            contrib = (links.join(share, ["src", "salt"]).groupBy("dst")
                       .agg(F.sum(F.col("share") * F.col("cnt")).alias("s")))
            new = ranks.join(contrib, ranks.id == contrib.dst, "left").select(
                "id", "deg", "nsalt", F.col("rank").alias("old"),
                (F.lit(p) * (F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(dangling / n)) + F.lit((1 - p) / n)).alias("rank"),
            )
            # The next dangling mass and the convergence test are observed while
            # the iteration is written: one job per iteration, two numbers back.
            obs = Observation(f"pagerank_{uuid.uuid4().hex}")
            new = new.observe(
                obs,
                F.sum(F.when(F.col("deg").isNull(), F.col("rank"))).alias("dangling"),
                F.sum(F.when(~within_tolerance(F.col("rank"), F.col("old"), rtol or 0.0, atol), 1)).alias("bad"),
            ).drop("old")
            done = shared_path(spark, "pagerank-ranks")
            ranks = read_back(new, done)
            if path:
                remove_path(spark, path)
            path = done
            stats = obs.get
            dangling, bad = stats["dangling"] or 0.0, stats["bad"]
            if rtol is not None and not bad:
                break
        else:
            if rtol is not None:
                raise RuntimeError(f"PageRank: {bad} of {n} nodes are not within tolerance after {max_iter} updates")
        # the nodes' table is still read where no update was asked for
        if path is None:
            del paths["nodes"]
        out, path = ranks.select("id", "rank"), None
        return out
    finally:  # also after an error, which leaves the last ranks behind
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        for p_ in [*paths.values(), *([path] if path else [])]:
            remove_path(spark, p_)


def top_ranks(ranks: DataFrame, n: int = 100) -> DataFrame:
    """K2: the ``n`` highest ranks, ties by id, with their position."""
    from pyspark.sql import Window as W

    order = [F.desc("rank"), F.asc("id")]
    top = ranks.orderBy(*order).limit(n)
    return top.withColumn("pos", F.row_number().over(W.orderBy(*order)).cast("long"))


def rank_of(ranks: DataFrame, node: int) -> DataFrame:
    """The rank of one node (looked up by id, D18)."""
    return ranks.where(F.col("id") == F.lit(node))


def graph_profile(edges: DataFrame) -> DataFrame:
    """The whole profile in long form, ``(section, kind, key, value)``.

    Sections: ``counts`` (A44), ``summary`` (A46) and ``histogram`` (A47, all
    degrees; the key is the degree).
    """
    def melt(df: DataFrame, section: str, kind, cols: list[str]) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in cols]))
        return df.select(F.lit(section).alias("section"), kind.alias("kind"), cells.alias("c")).select("section", "kind", "c.*")

    counts, summary = graph_counts(edges), degree_summary(edges)
    hist = degree_histogram(edges).select(
        F.lit("histogram").alias("section"), "kind", F.col("bucket").cast("string").alias("key"), F.col("n").cast("double").alias("value"))
    return (melt(counts, "counts", F.lit("all"), counts.columns)
            .unionByName(melt(summary, "summary", F.col("kind"), [c for c in summary.columns if c != "kind"])).unionByName(hist))
