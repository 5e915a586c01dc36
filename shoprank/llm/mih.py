"""Exact top-k search over binary codes by incremental multi-index hashing (operator 1).

Codes of ``bits`` bits are cut into ``m`` segments, and every distinct code is
indexed under the value of each of its segments. A query probes each segment
index with its own value first, then with all values one bit away, then two
bits, and so on. After radius ``r`` every code within Hamming distance
``m * (r + 1) - 1`` has been met, for it has a segment within ``r`` bits. A
query is finished when its kth verified distance is covered; the others go on
with the next radius, with their kth distance as the bound for what they still
take: with bound ``d`` only the segments up to ``d - m * r`` are probed at
radius ``r``, since a code first met by a later one is farther than ``d``. At
the full width of a segment everything is covered, so results are exact
whatever the codes are.

Rows of equal codes are one entry of the index (with its ``k + 1`` smallest
ids), and queries of equal codes are one query. A pair is verified once only:
at the radius of its closest segment, by the first such segment. The index is
written once, bucketed by segment value, so a round moves the probes alone;
probes are enumerated by built-in functions, with no list of masks in the plan.
Probes, bounds, hits and queries grow with the input, and the optimiser does
not see how many probes a query has: they are merged, never broadcast, so the
driver holds none of them.

Defined results: neighbours are ordered by distance, then id, and never
contain the query's own row; a null code or embedding is neither indexed nor
searched; null elements and missing ones count as 0 bits; repeated ids are
rows of their own but never neighbours of their own id; fewer than ``k``
other rows give fewer neighbours; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_path, written

BITS = 64
K = 10


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """A long whose bit ``i`` tells whether element ``i`` is above 0; null for a null vector."""
    code = F.lit(0).cast("long")
    for i in range(bits):
        value = (1 << i) - (1 << 64 if i == 63 else 0)
        code = code.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.when(vector.isNotNull(), code)


def segment_widths(n: int, bits: int = BITS) -> list[int]:
    """Widths of the segments for ``n`` codes: values of about ``log2(n) - 4`` bits, so a bucket holds some sixteen codes."""
    m = max(1, min(bits, round(bits / max(4.0, math.log2(max(2, n)) - 4))))
    return [bits // m + (i < bits % m) for i in range(m)]


def _segment(code: Column, widths: list[int], i: int) -> Column:
    return F.shiftrightunsigned(code, sum(widths[:i])).bitwiseAND(F.lit((1 << widths[i]) - 1 if widths[i] < 64 else -1).cast("long"))


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """``query_id, rank, neighbor_id, distance`` for ``queries`` against ``codes`` (both ``id, code``)."""
    spark = codes.sparkSession
    need = k + 1  # a query may meet its own row
    codes = written(codes.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code"), "codes")
    entries = written(codes.groupBy("code").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")), "code-entries")
    n = entries.count()
    widths = segment_widths(n, bits)
    m = len(widths)
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    buckets = int(conf) if conf.isdigit() else spark.sparkContext.defaultParallelism
    index = f"mih_index_{uuid.uuid4().hex}"
    of = lambda c: F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), _segment(c, widths, i).alias("val"), F.lit(widths[i]).alias("width")) for i in range(m)]))
    (entries.select("code", "first", "size", of(F.col("code")).alias("s")).select("s.seg", "s.val", "code", "first", "size")
     .repartition(buckets, "seg", "val").write.bucketBy(buckets, "seg", "val")
     .option("path", shared_path(spark, index)).saveAsTable(index))

    asked = written(queries.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code"), "queries")
    active = written(asked.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(bits).cast("long")), "open")
    best = None
    finished = []
    for r in range(max(widths) + 1):
        probes = active.select("q", "bound", of(F.col("q")).alias("s")).select("q", "bound", "s.seg", "s.val", "s.width", F.lit(-1).alias("hi"))
        probes = probes.where(F.col("seg") + F.lit(r * m) <= F.col("bound"))  # the others hold nothing within the bound
        for _ in range(r):  # flip one more bit, above the last one flipped
            probes = probes.where(F.col("hi") < F.col("width") - 1).select(
                "q", "bound", "seg", "val", "width", F.explode(F.sequence(F.col("hi") + 1, F.col("width") - 1)).alias("hi"))
            probes = probes.withColumn("val", F.col("val").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hi"))))
        probes = probes.select("q", "bound", "seg", "val")
        met = probes.hint("merge").join(spark.table(index), ["seg", "val"])
        x = F.col("q").bitwiseXOR(F.col("code"))
        closest = [F.bit_count(_segment(x, widths, i)) * m + i for i in range(m)]
        met = met.withColumn("dist", F.bit_count(x).cast("long")).where(
            ((F.least(*closest) if m > 1 else closest[0]) == F.lit(r * m) + F.col("seg")) & (F.col("dist") <= F.col("bound")))
        met = met.select("q", "dist", "first", "code", "size")
        if best is not None:
            met = met.unionByName(best)
        order = W.partitionBy("q").orderBy("dist", "first")
        top = met.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= need)
        # the distance at which the rows met so far number k + 1
        top = top.withColumn("_rows", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
        kth = F.min(F.when(F.col("_rows") >= need, F.col("dist"))).over(W.partitionBy("q"))
        top = written(top.withColumn("kth", kth).drop("_n", "_rows"), f"best-{r}")
        covered = m * (r + 1) - 1
        last = r == max(widths)
        over = F.lit(True) if last else F.coalesce(F.col("kth") <= covered, F.lit(False))
        finished.append(top.where(over).drop("kth"))
        best = top.where(~over).drop("kth")
        bounds = top.groupBy("q").agg(F.first("kth").alias("kth"))
        active = active.drop("bound").hint("merge").join(bounds, "q", "left").where(F.coalesce(F.col("kth") > covered, F.lit(not last)))
        active = written(active.select("q", F.coalesce("kth", F.lit(bits)).cast("long").alias("bound")), "open")
        if last or not active.limit(1).count():
            break
    spark.sql(f"DROP TABLE IF EXISTS {index}")
    found = finished[0]
    for f in finished[1:]:
        found = found.unionByName(f)
    ids = codes.distinct().withColumn("_n", F.row_number().over(W.partitionBy("code").orderBy("id"))).where(F.col("_n") <= need)
    hits = found.select("q", "dist", "code").hint("merge").join(ids.select("code", F.col("id").alias("neighbor_id")), "code")
    out = asked.distinct().select(F.col("id").alias("query_id"), F.col("code").alias("q")).hint("merge").join(hits.drop("code"), "q")
    out = out.where(F.col("neighbor_id") != F.col("query_id"))
    out = out.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "q").orderBy("dist", "neighbor_id"))).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id", F.col("dist").alias("distance"))
