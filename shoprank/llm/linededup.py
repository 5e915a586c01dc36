"""Line deduplication over levelled sorted runs (operator 4; built-in functions only).

The state is a set of runs: tables of line keys (128 bits of hash), disjoint,
sorted and bucketed by key, each with the smallest document that holds the
key. Documents come in batches in the order of their ids. Each batch reduces
its lines to its own keys (smallest and largest document of each), merge
anti-joins them with every run, and adds what is new as a run of level 0.
After every ``fanout`` runs of a level they are compacted into one run of the
next level, so a batch meets ``fanout * levels`` runs at most. The runs share
the bucketing, so the anti-joins move only the batch's own keys.

A key that a run or a smaller document already holds is dropped from the
document: all its lines there go. In its first document all its lines stay.

Skew: keys are aggregated on the map side before any shuffle, so a line that
a third of all documents hold costs one row per task; the drop list is a join
with plain shuffles, which adaptive execution splits at a hot key.

Defined results: a null or empty text is one empty line and stays empty
(the kept text of a null text is the empty text); keys shorter than
``min_chars`` code points are never dropped; rows with the same id are one
document; rows without an id are one document after all others; an empty
table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, remove, shared_path, written

MIN_CHARS = 10
BATCHES = 6
FANOUT = 3
KEY = ["h1", "h2"]
_LAST = (1 << 63) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), _UPPER, _LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc, row, pos, h1, h2``: every line whose key is long enough.

    ``doc`` orders the documents (rows without an id last); ``row`` tells
    texts of the same id apart, so that positions belong to one text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(_doc(id_col).alias("doc"), F.xxhash64(text).alias("row"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
    d = d.select("doc", "row", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return d.select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.concat(F.lit("\n"), F.col("key"))).alias("h2"))


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))


class LineRuns:
    """The levelled runs of line keys; ``add`` takes a batch and returns its drop list."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
        self.buckets = buckets or (int(conf) if conf.isdigit() else spark.sparkContext.defaultParallelism)
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _save(self, df: DataFrame, name: str) -> str:
        """A sorted, bucketed table in the shared folder; ``df`` is already partitioned by key, so one file per bucket."""
        name = f"line_{name}_{uuid.uuid4().hex}"
        self.paths[name] = shared_path(self.spark, name)
        (df.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", self.paths[name]).saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Drop list ``doc, row, pos`` of a batch whose documents all come after those of earlier batches."""
        own = lines.groupBy(*KEY).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        batch = self._save(own, "batch")
        new = self.spark.table(batch)
        for run in self.runs():
            new = new.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        run = self._save(new, "run")
        # keys that some document of the batch must lose: all but those new and in one document
        single = self.spark.table(run).where(F.col("first") == F.col("last")).select(*KEY)
        lost = self.spark.table(batch).select(*KEY).join(single.hint("merge"), KEY, "left_anti")
        fresh = self.spark.table(run).where(F.col("first") < F.col("last")).select(*KEY, "first")
        lost = written(lost.join(fresh, KEY, "left"), "line-lost")
        drops = lines.join(lost, KEY).where(F.col("first").isNull() | (F.col("doc") > F.col("first"))).select("doc", "row", "pos")
        self._drop(batch)
        self.levels[0].append(run)
        self._compact()
        return drops

    def _compact(self) -> None:
        """Merge each full level into one run of the next."""
        k = 0
        while len(self.levels[k]) >= self.fanout:
            if k + 1 == len(self.levels):
                self.levels.append([])
            full, self.levels[k] = self.levels[k], []
            merged = None
            for run in full:
                t = self.spark.table(run)
                merged = t if merged is None else merged.unionByName(t)
            self.levels[k + 1].append(self._save(merged.repartition(self.buckets, *KEY), f"level{k + 1}"))
            for run in full:
                self._drop(run)
            k += 1

    def close(self) -> None:
        for run in self.runs():
            self._drop(run)
        self.levels = [[]]


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc, row, drop`` (positions) of every text that loses lines.

    The lines' hashes are written once, in ``batches`` folders of ascending
    ids (limits by approximate quantiles: a batch's size matters for speed
    only), and each batch goes through the runs.
    """
    spark = docs.sparkSession
    cuts = docs.select(_doc(id_col).alias("doc")).agg(F.approx_percentile(
        "doc", F.array(*[F.lit((i + 1) / batches) for i in range(batches - 1)]), F.lit(1000)).alias("q")).first()["q"] or []
    at = F.lit(0)
    for c in sorted(set(cuts)):
        at = at + (F.col("doc") > F.lit(c)).cast("int")
    path = shared_path(spark, "lines")
    rows = line_rows(docs, id_col, text_col, min_chars).withColumn("batch", at)
    rows.write.partitionBy("batch").parquet(path)
    schema = rows.schema
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, fanout=fanout)
    out = None
    for b in range(len(set(cuts)) + 1):
        drops = runs.add(lines.where(F.col("batch") == b).drop("batch"))
        out = drops if out is None else out.unionByName(drops)
    runs.close()
    return written(out.groupBy("doc", "row").agg(F.collect_set("pos").alias("drop")), "line-drops")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """All columns of ``docs`` in ``_doc``, and ``n_lines, n_dropped, kept`` (the text of the lines that stay)."""
    drops = dropped_lines(docs, id_col, text_col, min_chars, batches, fanout)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), _doc(id_col).alias("doc"),
                    F.xxhash64(text).alias("row"), text.alias("_text"))
    d = d.join(drops, ["doc", "row"], "left")
    n = F.length("_text") - F.length(F.translate("_text", "\n", "")) + 1
    keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    lines = lines_of(F.col("_text"))
    kept = F.when(F.col("drop").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(keep, lambda i: F.col("_lines")[i]), "\n"))
    d = d.withColumn("_lines", F.when(F.col("drop").isNotNull(), lines))
    return d.select("_doc", n.cast("long").alias("n_lines"),
                    F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).cast("long").alias("n_dropped"), kept.alias("kept"))
