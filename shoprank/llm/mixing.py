"""Mixing sources to target weights (operator 3).

Every source gets a target number of words: its weight's share of
``epochs`` times all words, at most ``cap`` times its own size, the excess
reshared by weight until none is above. A source is taken in complete epochs
first; the rest of its target is filled by Efraimidis-Spirakis sampling:
document ``d`` of quality weight ``w`` gets the exponential key
``-ln(u) / w`` with ``u`` from a hash of its id, and documents are taken in
the order of their keys until the prefix sum of their sizes reaches the
budget. The document that crosses the budget is taken if that comes nearer.

Scale: keys are put into ordered buckets of about ``bucket_rows`` documents;
prefix sums run over the buckets' sums, and only the one bucket per source in
which the budget ends is sorted, to find the last document taken. The
decision is then a comparison with that document's key, so neither texts nor
ids are shuffled again and a hot source costs no more per task than others.

Defined results: null text has size 0; null source is a source of its own,
the last; rows equal in key, id and size are taken together; reruns agree
(keys depend on id and ``seed`` alone); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import n_words, written
from .quality import SYMBOLS

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
EPOCHS = 1.5
CAP = 2.0
BUCKET_ROWS = 50_000


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: short texts and texts full of symbols weigh less.

    ``min(1, (words + 1) / 51) * max(0.05, 1 - 5 * symbols / (code points + 1))``,
    at least 0.05.
    """
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    short = F.least(F.lit(1.0), (n_words(t) + F.lit(1)) / F.lit(51.0))
    clean = F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * symbols / (F.length(t) + F.lit(1)))
    return F.greatest(F.lit(0.05), short * clean)


def exponential_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """Efraimidis-Spirakis key ``-ln(u) / w``; ``u`` in (0, 1) from 48 bits of the id's MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    bits = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 48))) / weight


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, cap: float = CAP) -> DataFrame:
    """``source, source_size, source_docs, target`` from one row per source (``source, source_size, source_docs``).

    Sources take ``weights`` in turn by code point order, null last. Sorted
    by the level at which their caps are reached, the capped sources are a
    prefix; one running sum over the sources finds it. One row per source
    goes through these windows, never a document.
    """
    order = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_i"), F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_i", F.row_number().over(W.orderBy(*order)) - 1).withColumn("_w", weight)
    s = s.withColumn("_cap", F.lit(cap) * F.col("source_size")).withColumn("_level", F.col("_cap") / F.col("_w"))
    everything = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    so_far = W.partitionBy(F.lit(1)).orderBy("_level", "_i").rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("_total", F.lit(epochs) * F.sum("source_size").over(everything))
    s = s.withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(so_far), F.lit(0.0)))
    s = s.withColumn("_wleft", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(so_far), F.lit(0.0)))
    # the level all sources from here on would get, were they not capped
    s = s.withColumn("_try", F.col("_left") / F.col("_wleft"))
    # it rises while sources are capped and falls afterwards: its maximum is the level of the open sources
    target = F.least(F.col("_cap"), F.col("_w") * F.max("_try").over(everything))
    s = s.withColumn("_target", target)
    return s.select("source", "source_size", "source_docs", F.round("_target", 6).alias("target"))


def thresholds(keyed: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, cap: float = CAP,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per source: size, target, complete epochs, bucket count, and the last document of the fractional epoch.

    ``keyed``: ``doc_id, source, size, key``. A document is in the fractional
    epoch if its bucket is below ``last_bucket``, or equal and
    ``(key, doc_id, size) <= last``.
    """
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    t = written(source_targets(sizes, weights, epochs, cap), "targets")
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    t = t.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    t = t.withColumn("buckets", F.ceil(F.col("source_docs") / F.lit(bucket_rows)).cast("long"))
    in_bucket = _with_targets(keyed, t).withColumn("bucket", _bucket(F.col("key"), F.col("buckets")))
    sums = in_bucket.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cut = sums.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
    cut = written(cut.select(F.col("source").alias("_s"), F.col("bucket").alias("last_bucket"), F.col("before").alias("_before")), "cuts")
    edge = in_bucket.join(cut, in_bucket["source"].eqNullSafe(cut["_s"]) & (F.col("bucket") == F.col("last_bucket")))
    edge = edge.select("source", "key", "doc_id", "size", "rest", "_before")
    # ties share one frame: what ends with the tie, and what the tie itself holds
    tie = W.partitionBy("source", "key", "doc_id", "size")
    edge = edge.withColumn("_tie", F.sum("size").over(tie))
    order = _order()
    run = W.partitionBy("source").orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    edge = edge.withColumn("_sum", F.sum("size").over(run) + F.col("_before"))
    taken = (F.col("_sum") - F.col("_tie") < F.col("rest")) & (
        F.col("_sum") - F.col("rest") <= F.col("rest") - (F.col("_sum") - F.col("_tie")))
    last = edge.groupBy("source").agg(F.max(F.when(taken, order)).alias("last"))
    found = cut.join(last, cut["_s"].eqNullSafe(last["source"]), "left").select("_s", "last_bucket", "last")
    return t.join(found, t["source"].eqNullSafe(found["_s"]), "left").drop("_s", "source_docs")


def _bucket(key: Column, buckets: Column) -> Column:
    """Ordered bucket of a key: the exponential distribution function spreads keys over [0, 1)."""
    return F.least(buckets - 1, F.floor((F.lit(1.0) - F.exp(-key)) * buckets)).cast("long")


def _with_targets(keyed: DataFrame, t: DataFrame) -> DataFrame:
    t = t.withColumnRenamed("source", "_source")
    return keyed.join(t, keyed["source"].eqNullSafe(t["_source"]), "left").drop("_source")


def _order() -> Column:
    """The order of documents within a source: key, then id (null first), then size."""
    return F.struct(F.col("key"), F.col("doc_id").isNotNull().alias("has_id"),
                    F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("id"), F.col("size"))


def _times() -> Column:
    bucket = _bucket(F.col("key"), F.col("buckets"))
    # no cut: nothing is left to fill (rest 0); else all documents up to the last one taken
    part = F.coalesce((bucket < F.col("last_bucket")) | ((bucket == F.col("last_bucket")) & (_order() <= F.col("last"))), F.lit(False))
    return F.col("epochs") + part.cast("long")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, key`` of every document: built-in functions only."""
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    n_words(text).alias("size"), quality_weight(text).alias("_w"))
    return d.select("doc_id", "source", "size", exponential_key(F.col("doc_id"), F.col("_w"), seed).alias("key"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
        **how) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, ``taken`` = size times the copies in the mix."""
    k = written(keyed(docs, id_col, text_col, source_col, seed), "mix-keys")
    t = written(thresholds(k, **how), "mix-thresholds")
    out = _with_targets(k, t).withColumn("times", _times())
    return out.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times")


def repeat_mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 seed: str = SEED, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they came.

    Documents are read twice (keys, then decisions) and joined only to the
    one row of their source.
    """
    k = written(keyed(docs, id_col, text_col, source_col, seed), "mix-keys")
    t = written(thresholds(k, **how), "mix-thresholds")
    text = F.col(text_col).cast("string")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"),
                        quality_weight(text).alias("_w"))
    whole = whole.withColumn("key", exponential_key(F.col("doc_id"), F.col("_w"), seed))
    out = _with_targets(whole, t).withColumn("_times", _times()).where(F.col("_times") > 0)
    return out.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select("_doc.*")
