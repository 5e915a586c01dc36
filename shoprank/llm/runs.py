"""Periodic runs of words by recompression, and their collapse (operator 13).

A run is a stretch of words with smallest period q, of length at least
``max(least, times * q)``, which cannot be extended on either side with that
period. The texts of an Arrow batch are laid end to end, with a symbol of its
own between two, and treated at once with numpy:

1. *Recompression.* Words become integers. Alternately every block of equal
   symbols becomes one symbol (symbol and count), and every neighbouring pair
   whose left part is in one half of the alphabet and whose right part is in
   the other becomes one symbol; the halves are drawn by a hash of symbol and
   round. Equal stretches become equal symbols but for a bounded number at
   their ends, so the levels are a run-length grammar that represents every
   stretch alike wherever it stands. Each round drops about a quarter of the
   symbols or more, so there are O(log n) levels of O(n) symbols in total.
2. *Harmonic grid.* A run of period q has ``(times - 1) * q`` places i whose
   word equals the one at i + q, hence a multiple of ``(times - 1) * q``
   among them. For every q the grid places with equal words are candidates:
   O(n log n) comparisons of integers over all q.
3. *Exact extensions.* For a candidate (i, i + q) the longest common extension
   in both directions comes from the grammar: climb while the symbols are
   equal (at most one step aside per level), then descend to the first
   difference. All candidates are answered together, level by level; the
   mirrored grammar answers to the left. No suffix array, no hashing of words
   that could collide.
4. A stretch found with several periods keeps the smallest (by the theorem of
   Fine and Wilf the others are its multiples).

Work is O(n log n) per text whatever its words; memory is linear in the batch
(or in the one text that is longer), candidates are taken ``CANDIDATES`` at a
time. Texts are independent: no shuffle, so copies and hot words do not matter.

Defined results: null and empty texts have no words and no runs; texts with
fewer than ``least`` words have no runs; runs with equal start are ordered by
period; repeated rows are kept and null ids stay null; empty tables give no
rows; very long texts are treated whole; columns other than the two named are
not read, so clashing names do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LEAST, TIMES = 6, 4
CANDIDATES = 1 << 17
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: Fixed value: an odd 64-bit multiplier (the golden ratio's fraction) that mixes symbols before a bit is drawn.
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Level:
    """Symbols of one level and how they are grouped into the next one's (``first`` has one entry more)."""

    symbols: np.ndarray
    first: np.ndarray
    parent: np.ndarray
    blocks: bool

    def mirrored(self) -> Level:
        m, p = len(self.symbols), len(self.first) - 1
        return Level(self.symbols[::-1], m - self.first[::-1], p - 1 - self.parent[::-1], self.blocks)


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels of the run-length grammar of a sequence, from the sequence itself up to one symbol."""
    levels: list[Level] = []
    names, turn = int(symbols.max(initial=0)) + 1, 0
    while len(symbols) > 1:
        head = np.empty(len(symbols), bool)
        head[0] = True
        np.not_equal(symbols[1:], symbols[:-1], out=head[1:])
        if not head.all():
            levels.append(_level(symbols, head, True))
            size = np.diff(levels[-1].first)
            symbols, names = _renamed(symbols[head], size > 1, size, int(size.max()) + 1, names)
        turn += 1
        side = _halves(symbols, turn)
        joined = side[:-1] & ~side[1:]
        flipped = ~side[:-1] & side[1:]
        if flipped.sum() > joined.sum():
            joined = flipped
        if not joined.any():
            continue
        head = np.concatenate([[True], ~joined])
        levels.append(_level(symbols, head, False))
        second = np.append(symbols[1:], 0)[head]
        symbols, names = _renamed(symbols[head], np.append(joined, False)[head], second, names, names)
    return levels


def _halves(symbols: np.ndarray, turn: int) -> np.ndarray:
    mixed = (symbols.astype(np.uint64) + np.uint64(turn) * np.uint64(0xD1B54A33)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return (mixed * _MIX) >> np.uint64(63) == 1


def _level(symbols: np.ndarray, head: np.ndarray, blocks: bool) -> Level:
    first = np.append(np.flatnonzero(head), len(symbols))
    return Level(symbols, first, np.cumsum(head) - 1, blocks)


def _renamed(symbols: np.ndarray, which: np.ndarray, other: np.ndarray, span: int, names: int) -> tuple[np.ndarray, int]:
    """New names for the symbols in ``which``, equal where symbol and ``other`` (below ``span``) are equal."""
    kinds, index = np.unique(symbols[which] * span + other[which], return_inverse=True)
    out = symbols.copy()
    out[which] = names + index
    return out, names + len(kinds)


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common extension to the right of the places ``a`` and ``b`` (``a != b``).

    The sequence must end with a symbol that occurs once.
    """
    x, y = a.copy(), b.copy()
    top = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k, lv in enumerate(levels):
        i, j = x[live], y[live]
        same = lv.symbols[i] == lv.symbols[j]
        top[live[~same]] = k
        live, i, j = live[same], i[same], j[same]
        if not len(live):
            break
        p, q = lv.parent[i], lv.parent[j]
        aside = np.flatnonzero((i != lv.first[p]) | (j != lv.first[q]))
        differ = np.zeros(len(live), bool)
        if len(aside):  # a place inside a parent: step to the end of what is common at this level
            left, right = lv.first[p[aside] + 1] - i[aside], lv.first[q[aside] + 1] - j[aside]
            step = np.minimum(left, right) if lv.blocks else 1
            i[aside] += step
            j[aside] += step
            if lv.blocks:
                differ[aside] = left != right
            p[aside], q[aside] = lv.parent[i[aside]], lv.parent[j[aside]]
        x[live], y[live] = np.where(differ, i, p), np.where(differ, j, q)
        top[live[differ]] = k
        live = live[~differ]
    for k in range(int(top.max(initial=0)) - 1, -1, -1):
        lv = levels[k]
        live = np.flatnonzero(top > k)
        p, q = x[live], y[live]
        i, j = lv.first[p], lv.first[q]
        same = lv.symbols[i] == lv.symbols[j]
        step = np.minimum(lv.first[p + 1] - i, lv.first[q + 1] - j) if lv.blocks else 1
        x[live], y[live] = i + same * step, j + same * step
    return x - a


def candidates(text: np.ndarray, ends: np.ndarray, longest: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places with the same word one period on, as ``(places, periods)`` of about ``CANDIDATES`` at a time.

    The texts lie in ``text`` from the longest to the shortest; ``ends`` and
    ``longest`` are their ends and lengths, so a period meets only a prefix.
    """
    places, periods, held = [], [], 0
    for q in range(1, int(longest.max(initial=0)) // times + 1):
        n = int(ends[np.searchsorted(-longest, -times * q, side="right") - 1])
        step = (times - 1) * q
        for lo in range(0, max(0, n - q), step * CANDIDATES):
            hi = min(n - q, lo + step * CANDIDATES)
            found = lo + step * np.flatnonzero(text[lo:hi:step] == text[lo + q:hi + q:step])
            if len(found):
                places.append(found)
                periods.append(np.full(len(found), q))
                held += len(found)
            if held >= CANDIDATES:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Rows ``(start, length, period)`` of the runs of each sequence of non-negative integers, by start and period.

    ``times`` is 2 at least.
    """
    none = np.empty((0, 3), np.int64)
    out = [none] * len(texts)
    order = [i for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])) if len(texts[i]) >= least]
    if not order:
        return out
    words = max(int(texts[i].max()) for i in order) + 1
    parts = [np.array([words])]
    for rank, i in enumerate(order):
        parts += [texts[i], np.array([words + rank + 1])]
    text = np.concatenate(parts).astype(np.int64)
    size = np.array([len(texts[i]) for i in order])
    ends = np.cumsum(size + 1)  # place of the mark after each text
    levels = grammar(text)
    mirror = [lv.mirrored() for lv in levels]
    found = none
    for at, q in candidates(text, ends, size, times):
        fore = extensions(levels, at, at + q)
        back = extensions(mirror, len(text) - at, len(text) - at - q)
        span = fore + back + q
        good = span >= np.maximum(least, times * q)
        new = np.stack([at[good] - back[good], span[good], q[good]], axis=1)
        found = np.unique(np.concatenate([found, new]), axis=0)
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[keep]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    cut = np.searchsorted(found[:, 0], ends)
    lo = 0
    for rank, i in enumerate(order):
        if cut[rank] > lo:
            out[i] = found[lo:cut[rank]] - [ends[rank] - size[rank], 0, 0]
        lo = cut[rank]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, np.cumsum(edge[:-1]) == 0))


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a loop in every tenth document: from a place on, a stretch repeats to the end.

    Place and stretch follow from the crc32 of the id; a null id has no loop.
    """
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * times)[:n - a]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
                  prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Runs of every whole text and the text without their repetitions.

    Words are maximal runs without ASCII white space. Returns ``doc_id,
    n_words, runs`` (an array of ``start, length, period`` in words) and
    ``collapsed``, the kept words joined by one space. ``prepare`` may change
    the words of a text first (it gets the id and the words).
    """

    def run(batches):
        for b in small_batches(batches, max_bytes=2 << 20):
            ids = b.column(0).to_pylist()
            texts = [(x or b"").split() for x in b.column(1).to_pylist()]
            if prepare:
                texts = [prepare(i, t) for i, t in zip(ids, texts)]
            names: dict[bytes, int] = {}
            coded = [np.array([names.setdefault(w, len(names)) for w in t], np.int64) for t in texts]
            found = runs_of(coded, least, times)
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in found]
            kept = [b" ".join(collapse(t, r)) for t, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    text = F.col(text_col).cast("string").cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, SCHEMA)


def longest_by_exponent(runs: Column) -> Column:
    """The run with the greatest exact length / period of an array of runs (the first of equal ones); null if none."""
    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)


def with_digests(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent and digests from the result of :func:`periodic_runs`."""
    best = found.withColumn("_best", longest_by_exponent(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("_best.length * 1000 DIV _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
