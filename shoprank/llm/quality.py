"""Host-level quality rules (operator 2).

Every document is tested by two base rules: fewer than ``MIN_WORDS`` words,
or more than half of its words inside three-word windows that the text
repeats. Failures are summed per host. The hosts' failure rates are shrunk
towards their mean with a beta prior that is estimated from all hosts by the
method of moments, and a host whose shrunk rate is above ``max_rate`` is
rejected. The verdict goes back to the host's documents.

A host with few documents stays near the overall rate, so it is rejected only
on ample evidence; with the default of one half, a host falls when most of
its documents would fail by themselves.

Defined results: a null text has no words and fails; a null host has no host
verdict (its documents are judged by the base rules alone); repeated rows are
judged and counted each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, small_batches, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

BASE = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean")


def repeat_words(words: list) -> int:
    """Number of words inside three-word windows that occur at least twice in the list."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pair = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 1 << 20:  # three ids in one number would overflow
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * len(seen) + ids[2:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(n, bool)
    covered[:-2] |= again
    covered[1:-1] |= again
    covered[2:] |= again
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space exactly
    chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """One narrow row per document with the counts of the base rules; no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *((c, pa.int64()) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_())])

    def run(batches):
        for b in small_batches(batches, rows=2048):
            cols = list(zip(*(base_counts(t.as_py()) for t in b.column(2))))
            failed = [w < min_words or 100 * r > max_repeat * w for w, r in zip(cols[0], cols[4])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in cols), pa.array(failed)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, BASE)


def host_rates(base: DataFrame) -> DataFrame:
    """``host, host_docs, host_failed, host_rate``: failure rates shrunk with the empirical beta prior.

    Moments of all hosts (five sums, one row) give the mean rate and the
    intra-host correlation; the prior's strength is ``1 / correlation - 1``,
    held between 1 and 10,000 documents.
    """
    hosts = written(base.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")), "hosts")
    m = hosts.agg(
        F.count(F.lit(1)).alias("m"), F.sum("host_docs").alias("n"), F.sum("host_failed").alias("f"),
        F.sum(F.col("host_docs") * F.col("host_docs")).alias("nn"),
        F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs")).alias("ff")).first()
    mean, strength = beta_prior(m["m"], m["n"] or 0, m["f"] or 0, float(m["nn"] or 0), m["ff"] or 0.0)
    return hosts.withColumn("host_rate", (F.col("host_failed") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength)))


def beta_prior(hosts: int, n: int, failed: int, nn: float, ff: float) -> tuple[float, float]:
    """Mean and strength (documents) of the beta prior by the method of moments."""
    if not n:
        return 0.0, 1.0
    mean = failed / n
    spread = mean * (1 - mean)
    base = n - nn / n - (hosts - 1)
    if hosts < 2 or spread <= 0 or base <= 0:
        return mean, 10_000.0
    rho = (ff - n * mean * mean - spread * (hosts - 1)) / (spread * base)
    return mean, min(10_000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 10_000.0


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_rate: float = MAX_HOST_RATE, **rules) -> DataFrame:
    """The base counts of every document, its host's shrunk rate, and ``kept``.

    The narrow base rows are written once; hosts are summed with map-side
    aggregation, so a host with a third of all documents is no hot key, and
    the join back leaves broadcast or split to the optimiser, which knows the
    written hosts' size.
    """
    base = written(base_rules(docs, id_col, text_col, host_col, **rules), "base-rules")
    hosts = written(host_rates(base), "host-rates")
    out = base.join(hosts, "host", "left")
    host_failed = F.coalesce(F.col("host_rate") > F.lit(max_rate), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~host_failed).alias("kept"), "host", "host_docs", "host_rate")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
         max_rate: float = MAX_HOST_RATE, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The documents that pass, all columns as they came.

    A first pass over the documents sums the hosts; the second one applies
    the base rules to each text in place (a vectorised test), so texts are
    never shuffled and repeated ids need no row number.
    """
    from pyspark.sql.functions import pandas_udf

    base = written(base_rules(docs, id_col, text_col, host_col, min_words, max_repeat), "base-rules")
    bad = written(host_rates(base).where(F.col("host_rate") > F.lit(max_rate)).select(F.col("host").alias("_bad_host")), "bad-hosts")

    @pandas_udf("boolean")
    def failed(text):
        def one(t):
            c = base_counts(t)
            return c[0] < min_words or 100 * c[4] > max_repeat * c[0]

        return text.map(one)

    left = docs.join(bad, docs[host_col] == bad["_bad_host"], "left_anti")
    return left.where(~failed(F.coalesce(left[text_col].cast("string"), F.lit(""))))
