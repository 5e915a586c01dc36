"""Toxicity by a character n-gram classifier with naive Bayes log-count ratios (operator 6).

Features: the distinct character n-grams (3 to 5 code points, lower case,
each run of white space one space, a space at both ends) hashed into
``2 ** bits`` buckets. Each is scaled by its naive Bayes log-count ratio
``r = log((p + a) / |p + a|) - log((q + a) / |q + a|)`` with ``p`` and ``q``
the numbers of toxic and clean training texts that hold it. A logistic
regression is fitted on the scaled features, class weights balanced.

Training takes a bounded sample of the labelled rows: at most ``max_rows`` of
each class, those smallest by a hash of their id, each at most ``max_chars``
code points from a place given by the same hash. Scoring reads whole texts.

Scores depend on the text alone. Defined results: a null text scores as the
empty text (no features: the intercept); without training rows, or with clean
ones alone, every score is near 0, with toxic ones alone near 1; labelled ids
that repeat count each row; unlabelled rows are scored like all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

BITS = 20
NGRAMS = (3, 4, 5)
MAX_ROWS = 1500
MAX_CHARS = 4000
ALPHA = 0.5
_MULTIPLY, _SCATTER, _FIFTEEN = np.uint32(0x85EBCA6B), np.uint32(0x9E3779B1), np.uint32(15)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted distinct buckets of the text's character n-grams."""
    t = " " + " ".join((text or "").lower().split()) + " "
    code = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
    h = np.full(len(code), 0x811C9DC5, np.uint32)
    parts = []
    for n in range(1, NGRAMS[-1] + 1):
        if n > len(code):
            break
        h = (h[:len(code) - n + 1] ^ code[n - 1:]) * _MULTIPLY
        h ^= h >> _FIFTEEN
        if n in NGRAMS:
            parts.append((h * _SCATTER) >> np.uint32(32 - bits))
    if not parts:
        return np.empty(0, np.int32)
    g = np.concatenate(parts).view(np.int32)
    g.sort()
    return g[np.concatenate(([True], g[1:] != g[:-1]))]


def training_sample(labelled: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` rows of each class (``doc_id, text, label``), those smallest by a hash of the id."""
    order = [F.xxhash64(F.lit("toxic"), "doc_id"), F.col("doc_id")]
    ids = labelled.select("doc_id", "label")
    parts = [ids.where(F.col("label") == c).orderBy(*order).limit(max_rows) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(rows: list[tuple[str | None, int]], bits: int = BITS, alpha: float = ALPHA, rounds: int = 80,
        l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights (one per bucket, the ratio multiplied in) and intercept from ``(text, label)`` rows."""
    weights = np.zeros(1 << bits, np.float32)
    y = np.array([r[1] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return weights, 20.0 if len(y) and y[0] else -20.0
    lists = [features(t, bits) for t, _ in rows]
    sizes = np.array([len(x) for x in lists])
    flat = np.concatenate(lists)
    of = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    toxic = np.bincount(flat, weights=y[of], minlength=1 << bits)
    clean = np.bincount(flat, minlength=1 << bits) - toxic
    used = np.flatnonzero(toxic + clean > 1)  # what occurs once cannot generalise
    ratio = np.log((toxic[used] + alpha) / (toxic.sum() + alpha * len(used))) - np.log((clean[used] + alpha) / (clean.sum() + alpha * len(used)))
    place = np.full(1 << bits, -1, np.int32)
    place[used] = np.arange(len(used))
    col = place[flat]
    ok = col >= 0
    col, row = col[ok], of[ok].astype(np.int32)
    del lists, flat, of, place, ok
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # balanced classes
    begin = np.searchsorted(row, np.arange(len(y) + 1))
    full = np.flatnonzero(np.diff(begin))

    # the scaled columns in row order; steps by Nesterov's method with a step size from the largest row
    value = ratio[col].astype(np.float32)
    w, b, w0, b0 = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    norms = np.zeros(len(y))
    norms[full] = np.add.reduceat(value * value, begin[full], dtype=np.float64)
    step = 1.0 / (0.25 * (float((share * (norms + 1)).sum())) + l2)
    for k in range(rounds):
        m = k / (k + 3)
        v, c = w + m * (w - w0), b + m * (b - b0)
        z = np.full(len(y), c)
        z[full] += np.add.reduceat(value * v.astype(np.float32)[col], begin[full], dtype=np.float64)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.bincount(col, weights=value * g.astype(np.float32)[row], minlength=len(used)) + l2 * v
        w0, b0 = w, b
        w, b = v - step * grad, c - step * g.sum()
    weights[used] = (w * ratio).astype(np.float32)
    return weights, float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS, bits: int = BITS) -> tuple[np.ndarray, float]:
    """Fit on the bounded sample of ``labels`` joined to their texts.

    The sample's ids are chosen on the narrow labels, so that texts are read
    for the sample only; ``2 * max_rows * max_chars`` code points at most come
    to the driver.
    """
    lab = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    ids = written(training_sample(lab, max_rows), "toxic-sample")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    start = F.pmod(F.xxhash64(docs[id_col].cast("long")), F.greatest(F.lit(1), F.length(text) - F.lit(max_chars))).cast("int") + 1
    sample = docs.select(docs[id_col].cast("long").alias("doc_id"), F.substring(text, start, F.lit(max_chars)).alias("text"))
    rows = sample.join(ids, "doc_id").orderBy("doc_id", "label", F.xxhash64("text")).limit(4 * max_rows).collect()
    return fit([(r["text"], r["label"]) for r in rows], bits)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; the weights (``2 ** bits`` floats, a fixed size) are broadcast."""
    weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value
        bits = len(w).bit_length() - 1
        seen = np.zeros(len(w), bool)
        for b in small_batches(batches):
            z = np.array([float(w[features(t.as_py(), bits)].sum(dtype=np.float64)) for t in b.column(1)]) + bias
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
