"""Near-duplicate documents by order MinHash and banded alignment (operator 5).

Sketch: each text's words (runs without ASCII white space, A-Z in lower case)
give its five-word k-mers, labelled with their occurrence number in the text.
For each of ``bands`` hash functions the ``length`` smallest labelled k-mers
are sampled and kept in text order, so that a band of two texts agrees only
where they share the k-mers and their order: the chance follows edit
similarity, not only set similarity.

Candidates, in three rounds whatever the data:

1. Texts with equal words form a class first. In every band's bucket each
   member meets the bucket's smallest node.
2. Buckets that still hold several classes are sorted, for each band, by the
   values of that band and the following ones (then length and node), and
   each member meets the ``WINDOW`` members before it, if they are of other
   classes. Near-duplicates agree in most bands, so in one of the rotations
   of the bands they stand side by side even in a bucket that thousands of
   unlike texts share. Buckets are dealt out by range, so a large one is cut
   over tasks; the rows at the cuts meet in a small pass of their own. Pairs
   that agree in fewer than ``MIN_AGREE`` bands, or whose lengths rule them
   out, are left to the third round.
3. In buckets that still hold several classes all members of different classes
   meet, chunk by chunk, whatever the size of the bucket. Only pairs that
   cannot be near (by their lengths, or by how many words one has and the
   other lacks) leave the chunk no further; these bounds are exact. Words are
   counted by 128 hash values first and by 65,536 for what passes, so that
   texts just beyond the similarity are refused there too. Of what is left
   each class's closest pair is aligned first, and then the pairs that are
   still of different classes. A bucket of many
   texts that stay unlike costs the square of its members in cheap
   comparisons, spread over tasks in bounded memory.

Verification: texts that share too few words or two-word windows are refused,
the others get the Levenshtein distance of the word sequences inside the band
of diagonals that ``similarity`` allows; a link needs
``1 - distance / longer length >= similarity``. The text that several pairs
share goes to each of its tasks once and the pairs' other texts follow it.

Result: connected classes of the links, named by their smallest id.

Recall: two texts of five-word-shingle similarity J agree in a band with a
chance of about J * J; with 20 bands they share no band with a chance of about
1e-9 for J = 0.8 and 0.3 % for J = 0.5. Pairs that share a band are all
compared or already in one class; none is left out by a bucket's size.

Defined results: texts without words are not duplicates of each other; texts
of fewer than five words only match equal word sequences; two texts under one
id are two texts; a row without an id is known by a negative number made of
its text's hash; rows repeated with id and text fall into one class and share
its verdict, and one of them stays; very long texts are compared whole; an
empty table gives no rows; only the named columns are read, all columns are
returned as they came, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import read_back, shared_path
from .common import scratch, small_batches, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
LENGTH = 2
SEED = 20240229
#: Neighbours that a member of a bucket meets in the second round, and bands that a pair has to agree in there.
WINDOW = 16
MIN_AGREE = 5
#: Members of a bucket in a chunk of the third round, their words, and hash values of a text's word counts.
CHUNK, CHUNK_WORDS, BAG = 1000, 4_000_000, 128
#: Words up to which a text carries 16 bits of each word to the third round.
MARK_WORDS = 1 << 16
#: Pairs of one text that a task aligns.
PAIRS_A_TASK = 500

_U = np.uint64
_PIECE = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift and odd multiplications)."""
    x = x ^ (x >> _U(31))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(29))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


_UP, _DOWN = _powers(_BASE, _PIECE + 1), _powers(_INV, _PIECE + 1)


def _space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words of a byte array, piece by piece in bounded memory."""
    hashes, starts, lo = [], [], 0
    while lo < len(raw):
        hi = min(len(raw), lo + _PIECE)
        if hi < len(raw):
            gap = np.flatnonzero(_space(raw[lo:hi]))
            if len(gap):
                hi = lo + int(gap[-1]) + 1
            else:  # one word longer than a piece
                gap = np.flatnonzero(_space(raw[hi:]))
                hi = hi + int(gap[0]) + 1 if len(gap) else len(raw)
        part = raw[lo:hi]
        up, down = (_UP, _DOWN) if len(part) <= _PIECE else (_powers(_BASE, len(part) + 1), _powers(_INV, len(part) + 1))
        edge = np.diff(np.concatenate(([0], (~_space(part)).astype(np.int8), [0])))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate((np.zeros(1, _U), np.cumsum((part.astype(_U) + _U(1)) * up[:len(part)], dtype=_U)))
        hashes.append(_mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U)))
        starts.append(s + lo)
        lo = hi
    if not hashes:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _occurrences(kmers: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """k-mer hashes relabelled with their occurrence number inside their document."""
    key = kmers ^ _mix(doc.astype(_U) + _U(77))
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return kmers
    out = kmers.copy()
    at = np.flatnonzero(np.isin(key, twice))
    by = at[np.argsort(key[at], kind="stable")]
    new = np.concatenate(([True], key[by][1:] != key[by][:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    number = (np.arange(len(by)) - first).astype(_U)
    out[by] = np.where(number == 0, kmers[by], _mix(kmers[by] + number * _U(0xD6E8FEB86659FD93)))
    return out


def sketch(words: np.ndarray, counts: np.ndarray, bands: int = BANDS, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """Band values (documents x bands) of documents whose word hashes lie one after another.

    Documents of fewer than ``SHINGLE`` words get zeros. All documents go
    through each step together.
    """
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 1 << 63, SHINGLE, dtype=_U) | _U(1)
    salts = rng.integers(1, 1 << 63, bands, dtype=_U)
    out = np.zeros((len(counts), bands), _U)
    n = np.maximum(counts - SHINGLE + 1, 0)
    if not n.sum():
        return out
    doc = np.repeat(np.arange(len(counts)), n)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    begin = np.concatenate(([0], np.cumsum(n)[:-1]))
    at = np.arange(len(doc)) - np.repeat(begin, n) + np.repeat(first, n)
    kmers = np.zeros(len(doc), _U)
    for k in range(SHINGLE):
        kmers += words[at + k] * weights[k]
    kmers = _mix(kmers)
    labelled = _occurrences(kmers, doc)
    full = np.flatnonzero(n)
    start, size = begin[full], n[full]
    top = _U(0xFFFFFFFFFFFFFFFF)
    for j in range(bands):
        h = (labelled ^ salts[j]) * _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        h *= _U(0x94D049BB133111EB)
        h ^= h >> _U(29)
        picks = np.full((length, len(full)), len(doc), np.int64)
        for k in range(length):
            least = np.minimum.reduceat(h, start)
            pos = np.flatnonzero((h == np.repeat(least, size)) & (h != top))
            d = np.searchsorted(start, pos, "right") - 1
            d, one = np.unique(d, return_index=True)
            picks[k, d] = pos[one]
            h[pos[one]] = top
        picks.sort(axis=0)  # text order
        value = np.full(len(full), salts[j], _U)
        padded = np.concatenate((kmers, np.zeros(1, _U)))
        for k in range(length):
            value = _mix(value * _U(0x9E3779B97F4A7C15) + padded[picks[k]])
        out[full, j] = value
    return out


def sketch_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS,
                length: int = LENGTH) -> DataFrame:
    """``doc, text_hash, h1, h2, n, sketch, agree, tokens`` of every text with words; one pass, no shuffle.

    ``h1, h2``: 128 bits over the word sequence; ``agree``: 32 bits of each
    band's value; ``tokens``: 32 bits of each word's hash for the alignment.
    """
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32()),
                        ("sketch", pa.list_(pa.int64())), ("agree", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        for b in small_batches(batches, rows=2048, max_bytes=2 << 20):
            raws = [(t.as_py() or "").encode().lower() for t in b.column(2)]
            raw = np.frombuffer(b"\n".join(raws), np.uint8)
            edges = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
            words, starts = word_hashes(raw)
            at = np.searchsorted(starts, edges)
            counts = np.diff(at)
            values = sketch(words, counts, bands, length).view(np.int64)
            small = (words >> _U(32)).astype("<u4")
            part = (values.view(_U) >> _U(32)).astype("<u4")
            ids, hashes = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows = [[] for _ in schema]
            for i in np.flatnonzero(counts):
                lo, hi = at[i], at[i + 1]
                h = np.frombuffer(hashlib.blake2b(words[lo:hi].tobytes(), digest_size=16).digest(), np.int64)
                for col, x in zip(rows, (int(ids[i]), int(hashes[i]), int(h[0]), int(h[1]), int(hi - lo),
                                         values[i] if hi - lo >= SHINGLE else [], part[i].tobytes(), small[lo:hi].tobytes())):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return docs.select(doc_key(id_col, text_col).alias("doc"), text_hash(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, "doc long, text_hash long, h1 long, h2 long, n int, sketch array<long>, agree binary, tokens binary")


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id, or a negative number from the text's hash where it is null."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-1) - F.pmod(text_hash(text_col), F.lit(1 << 62)))


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and their counts."""
    x = np.sort(x)
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)
    return x[first], np.diff(np.append(first, len(x)))


def _windows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct two-word windows of a text and their counts."""
    return _counted(a[:-1].astype(_U) << _U(32) | a[1:])


def _shared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Multiset overlap of the words or the two-word windows of two texts."""
    (u, cu), (v, cv) = a, b
    if not len(u) or not len(v):
        return 0
    at = np.minimum(np.searchsorted(u, v), len(u) - 1)
    return int(np.minimum(cu[at], cv)[u[at] == v].sum())


#: Edits up to which the furthest cells are followed diagonal by diagonal, and words up to which columns are bit vectors.
FEW_EDITS, BIT_WORDS = 16, 20_000
#: The same number of edits for texts of up to so many words, whose columns cost less than many diagonals.
SHORT_EDITS, SHORT_WORDS = 3, 400


def places(a: np.ndarray) -> dict[int, int]:
    """Of every word of a text the set of its places, as a number with a bit per place."""
    order = np.argsort(a, kind="stable")
    words, first = np.unique(a[order], return_index=True)
    out = {}
    for w, at in zip(words.tolist(), np.split(order, first[1:])):
        bits = 0
        for i in at.tolist():
            bits |= 1 << i
        out[w] = bits
    return out


def _bit_columns(a: dict[int, int], n: int, b: np.ndarray, limit: int) -> int:
    """Levenshtein distance of a text of ``n`` words (its ``places``) and ``b``, or ``limit + 1``.

    A column of the alignment table is two bit vectors, the places where it
    rises and where it falls; the next column follows from a few operations
    on them. It ends as soon as the last cell cannot come back to ``limit``.
    """
    whole, top, score, left = (1 << n) - 1, 1 << (n - 1), n, len(b)
    rise, fall = whole, 0
    for w in b.tolist():
        same = a.get(w, 0)
        zero = (((same & rise) + rise) ^ rise) | same | fall
        up, down = fall | (whole ^ ((zero | rise) & whole)), zero & rise
        score += 1 if up & top else -1 if down & top else 0
        left -= 1
        if score - left > limit:
            return limit + 1
        up = (up << 1 | 1) & whole
        rise = (down << 1 & whole) | (whole ^ ((zero | up) & whole))
        fall = up & zero
    return min(score, limit + 1)


def distance(a: np.ndarray, b: np.ndarray, limit: int, at: dict[int, int] | None = None) -> int:
    """Levenshtein distance of two sequences, or ``limit + 1`` if it is larger.

    Only diagonals within the band of ``limit`` are visited: for each number
    of edits the furthest cell of each diagonal is kept, and equal stretches
    are skipped by the diagonal's list of mismatches. Beyond ``FEW_EDITS``
    edits (``SHORT_EDITS`` for short texts) the table is computed column by column with bit vectors (``at``: the
    ``places`` of ``a``, where they are known), and for very long texts row by
    row within the band.
    """
    whole = a, b
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    m = min(len(a), len(b))
    off = np.flatnonzero(a[:m] != b[:m])
    head = int(off[0]) if len(off) else m
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    off = np.flatnonzero(a[len(a) - m:][::-1] != b[len(b) - m:][::-1])
    tail = int(off[0]) if len(off) else m
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return min(max(n, m), limit + 1)
    gaps: dict[int, np.ndarray] = {}

    def slide(i: int, k: int) -> int:
        """Row where diagonal ``k`` (column - row) stops matching, from row ``i``."""
        if k not in gaps:
            lo, hi = max(0, -k), min(n, m - k)
            gaps[k] = np.append(np.flatnonzero(a[lo:hi] != b[lo + k:hi + k]) + lo, hi)
        g = gaps[k]
        return int(g[g.searchsorted(i)]) if i < g[-1] else i

    few = FEW_EDITS if max(map(len, whole)) > SHORT_WORDS else SHORT_EDITS
    goal = m - n
    reach = {0: slide(0, 0)}
    if goal == 0 and reach[0] >= n:
        return 0
    for e in range(1, min(limit, few) + 1):
        new = {}
        for k in range(max(-e, -n), min(e, m) + 1):
            if abs(goal - k) > limit - e:  # cannot come back to the last diagonal in time
                continue
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1, max(0, -k) if abs(k) == e else -1)
            i = min(i, n, m - k)
            if i >= max(0, -k):
                new[k] = slide(i, k)
        reach = new
        if reach.get(goal, -1) >= n:
            return e
    if limit <= few:
        return limit + 1
    a, b = whole
    return _bit_columns(at or places(a), len(a), b, limit) if len(a) <= BIT_WORDS else _banded_rows(a, b, limit)


def _banded_rows(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Row-by-row banded Levenshtein distance (for many edits), or ``limit + 1``."""
    n, m = len(a), len(b)
    far = limit + 1
    row = np.arange(m + 1)
    row = np.where(row <= limit, row, far)
    for i in range(1, n + 1):
        lo, hi = max(1, i - limit), min(m, i + limit)
        new = np.full(m + 1, far)
        if lo == 1:
            new[0] = min(i, far)
        j = np.arange(lo, hi + 1)
        best = np.minimum(row[lo - 1:hi] + (a[i - 1] != b[lo - 1:hi]), row[lo:hi + 1] + 1)
        chain = np.minimum.accumulate(np.concatenate(([new[lo - 1]], best)) - np.arange(lo - 1, hi + 1))
        new[lo:hi + 1] = np.minimum(chain[1:] + j, far)
        row = new
        if row[max(0, lo - 1):hi + 1].min() >= far:
            return far
    return int(min(row[m], far))


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY, known: tuple | None = None) -> bool:
    """Whether ``1 - distance / longer length`` reaches ``similarity``.

    Each edit destroys one word and two of the two-word windows at most, so
    texts that share too few of them are refused before the alignment.
    ``known``: the words, the windows and the places of ``a``.
    """
    longer = max(len(a), len(b))
    limit = int(longer * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > limit or _shared(known[0] if known else _counted(a), _counted(b)) < longer - limit:
        return False
    if _shared(known[1] if known else _windows(a), _windows(b)) < longer - 1 - 2 * limit:
        return False
    return distance(a, b, limit, known[2] if known else None) <= limit


def verify(pairs: DataFrame, tokens: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b, near`` for distinct pairs (``a, b``) by aligning the texts' tokens (``doc, tokens``).

    The pairs of a text ``a`` are dealt over as many tasks as they fill; there
    its tokens come first and the other texts' follow as a stream.
    """
    tasks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAIRS_A_TASK)).alias("tasks"))
    head = tasks.withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))).join(tokens, F.col("a") == F.col("doc"))
    body = pairs.join(tasks, "a").withColumn("task", F.pmod(F.xxhash64("b"), F.col("tasks"))).join(tokens, F.col("b") == F.col("doc"))
    stream = head.select("a", "task", F.lit(None).cast("long").alias("b"), "tokens").unionByName(body.select("a", "task", "b", "tokens"))

    def run(batches):
        words, known = None, None
        for batch in small_batches(batches):
            a, b, near = [], [], []
            for i, j, raw in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                other = np.frombuffer(raw, "<u4")
                if j is None:
                    words, known = other, (_counted(other), _windows(other), places(other) if len(other) <= BIT_WORDS else None)
                else:
                    a.append(i)
                    b.append(j)
                    near.append(similar(words, other, similarity, known))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near, pa.bool_())], ["a", "b", "near"])

    return stream.repartition("a", "task").sortWithinPartitions("a", "task", "b").mapInArrow(run, "a long, b long, near boolean")


def linked(reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc, label`` of the representatives (``doc, n, sketch, agree, tokens``) that share a band: the connected classes of their verified links.

    Three rounds of candidates (see above); pairs of one class, or aligned
    before, are not aligned again.
    """
    stars = written(_stars(reps.select("doc", F.posexplode("sketch").alias("band", "value"))), "band-stars")
    need = written(stars.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "band-members")
    known = written(reps.join(need, "doc", "left_semi").select("doc", "n", "sketch", "agree", "tokens"), "band-texts")
    tokens, state = known.select("doc", "tokens"), known.select("doc", F.col("doc").alias("label"))

    def aligned(pairs):
        checked = written(verify(pairs.select("a", "b"), tokens, similarity), "band-checked")
        return checked.select("a", "b"), _joined(state, checked.where("near").select("a", "b"))

    tried, state = aligned(stars)
    # classes only merge, so a bucket that is left out once stays out
    members = _contested(known.select("doc", F.posexplode("sketch").alias("band", "value")), state)
    more, state = aligned(written(_window_pairs(known, members, WINDOW, similarity).join(tried, ["a", "b"], "left_anti"), "band-pairs"))
    members = _contested(members, state)
    rest = written(_rest_pairs(known, members, similarity).join(tried.unionByName(more), ["a", "b"], "left_anti"), "band-pairs")
    _, state = aligned(rest.where("closest"))
    left, right = (state.select(F.col("doc").alias(x), F.col("label").alias("l" + x)) for x in "ab")
    apart = rest.where("NOT closest").join(left, "a").join(right, "b").where("la <> lb").select("a", "b")
    return aligned(written(apart, "band-pairs"))[1]


def _joined(state: DataFrame, near: DataFrame) -> DataFrame:
    """``doc, label`` after the links ``near`` (``a, b``): their classes merged."""
    left, right = (state.select(F.col("doc").alias(x), F.col("label").alias("l" + x)) for x in "ab")
    edges = near.join(left, "a").join(right, "b").where(F.col("la") != F.col("lb")).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    merged = components(edges).select(F.col("doc").alias("label"), F.col("label").alias("_to"))
    return written(state.join(merged, "label", "left").select("doc", F.coalesce("_to", "label").alias("label")), "band-classes")


def _stars(bands: DataFrame) -> DataFrame:
    """``a, b``: every member of a bucket (``doc, band, value``) with the bucket's smallest id, each pair once."""
    hubs = bands.groupBy("band", "value").agg(F.min("doc").alias("a"), F.max("doc").alias("_z"))
    hubs = hubs.where(F.col("a") < F.col("_z")).drop("_z")
    return bands.join(hubs, ["band", "value"]).where(F.col("doc") != F.col("a")).select("a", F.col("doc").alias("b")).distinct()


def _contested(members: DataFrame, state: DataFrame) -> DataFrame:
    """``doc, band, value, label``: the members of buckets that hold several classes, without their texts and sketches."""
    rows = members.select("doc", "band", "value").join(state, "doc")
    several = rows.groupBy("band", "value").agg(F.min("label").alias("_l"), F.max("label").alias("_m")).where(F.col("_l") < F.col("_m"))
    return written(rows.join(several.select("band", "value"), ["band", "value"], "left_semi").select("doc", "band", "value", "label"), "band-rows")


def _window_pairs(known: DataFrame, members: DataFrame, width: int, similarity: float) -> DataFrame:
    """``a, b``: members (``_contested``) of different classes that stand within ``width`` places in the sorted buckets."""
    after = [F.element_at("sketch", (F.pmod(F.col("band") + k, F.size("sketch")) + 1).cast("int")).alias(f"next{k}") for k in (1, 2)]
    rows = members.join(known.select("doc", "n", "agree", "sketch"), "doc").select("band", "value", *after, "n", "doc", "label", "agree")
    order = ["band", "value", "next1", "next2", "n", "doc"]
    cols = ["band", "value", "n", "doc", "label", "agree"]

    def first(batches):
        from pyspark import TaskContext

        return _neighbours(batches, width, similarity, TaskContext.get().partitionId())

    out = "a long, b long, cut int, place int, band int, value long, n int, doc long, label long, agree binary"
    met = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*cols).mapInArrow(first, out), "band-window")
    edge = met.where("cut IS NOT NULL").repartition("cut").sortWithinPartitions("cut", "place").select(*cols, "cut")
    across = edge.mapInArrow(lambda it: _neighbours(it, width, similarity, None), out)
    return met.where("cut IS NULL").select("a", "b").unionByName(across.where("cut IS NULL").select("a", "b")).distinct()


def _neighbours(batches, width: int, similarity: float, part: int | None):
    """Candidate pairs of sorted rows ``band, value, n, doc, label, agree``; with the task's number also its first and last rows.

    The last rows of task p and the first of task p + 1 belong to cut p, in
    that order (``place``).
    """
    names = ["a", "b", "cut", "place", "band", "value", "n", "doc", "label", "agree"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    held, seen, numbers = None, 0, [0, 1, 2, 3, 4] + ([6] if part is None else [])

    def pairs(rows, agree, old):
        a, b = [], []
        for d in range(1, min(width, len(agree) - 1) + 1):
            lo = max(0, old - d)
            x, y = slice(lo, len(agree) - d), slice(lo + d, len(agree))
            same = (rows[y, 4] != rows[x, 4]) & (rows[y, 1] == rows[x, 1]) & (rows[y, 0] == rows[x, 0])
            same &= np.minimum(rows[x, 2], rows[y, 2]) >= similarity * np.maximum(rows[x, 2], rows[y, 2]) - 1e-9
            if part is None:
                same &= rows[y, 5] == rows[x, 5]
            i = np.flatnonzero(same)
            i = i[(agree[x][i] == agree[y][i]).sum(axis=1) >= MIN_AGREE] + lo
            a.append(np.minimum(rows[i, 3], rows[i + d, 3]))
            b.append(np.maximum(rows[i, 3], rows[i + d, 3]))
        return [np.unique(np.stack([np.concatenate(z or [np.empty(0, np.int64)]) for z in (a, b)], axis=1), axis=0)]

    def table(found, edge=()):
        a, b = (found[:, 0], found[:, 1]) if len(found) else ([], [])
        none = [None] * len(a)
        cols = [list(a) + [None] * len(edge), list(b) + [None] * len(edge)] + [none + [e[i] for e in edge] for i in range(8)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in numbers], axis=1)
        agree = np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u4").reshape(batch.num_rows, -1)
        edge = []
        if part is not None and seen < width:
            edge = [(part - 1, width + seen + i, *map(int, rows[i, :5]), agree[i].tobytes()) for i in range(min(width - seen, len(rows)))]
        old = 0 if held is None else len(held[0])
        if old:
            rows, agree = np.concatenate([held[0], rows]), np.concatenate([held[1], agree])
        seen += batch.num_rows
        yield table(pairs(rows, agree, old)[0], edge)
        held = rows[-width:], agree[-width:]
    if held is not None and part is not None:
        k = len(held[0])
        yield table(np.empty((0, 2), np.int64), [(part, i, *map(int, held[0][i, :5]), held[1][i].tobytes()) for i in range(k)])


def _rest_pairs(known: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """``a, b, closest``: all members (``_contested``) of different classes that share a bucket, but for those that lengths or word counts rule out.

    The members of a bucket are dealt over chunks of about ``CHUNK`` of them
    and ``CHUNK_WORDS`` words, and every two chunks meet in a cell of their
    own, so a task holds two chunks at a time however large the bucket is.
    """
    sizes = members.join(known.select("doc", F.least("n", F.lit(MARK_WORDS)).alias("_n")), "doc").groupBy("band", "value")
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(CHUNK), F.sum("_n") / F.lit(CHUNK_WORDS)))
    rows = members.join(sizes.agg(chunks.alias("chunks")), ["band", "value"])
    bags = known.select("doc", "n", "tokens").mapInArrow(_bags, "doc long, n int, bag binary, marks binary")  # less to move than the tokens
    rows = rows.join(bags, "doc").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("chunks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cell = ["band", "value", "i", "j"]
    rows = rows.select("band", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "label", "n", "bag", "marks")
    met = rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(lambda it: _cell_pairs(it, similarity), "a long, b long, closest boolean")
    return met.groupBy("a", "b").agg(F.max("closest").alias("closest"))


def _bags(batches):
    """``doc, n, bag, marks``: how many words of a text fall on each of ``BAG`` hash values (255 at most), and the words' ``marks``."""
    for b in small_batches(batches, rows=2048):
        texts = [np.frombuffer(t, "<u4") for t in b.column(2).to_pylist()]
        bags = [np.minimum(np.bincount(t % BAG, minlength=BAG), 255).astype(np.uint8).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.binary()) for c in (bags, [marks(t).tobytes() for t in texts]))],
                                         ["doc", "n", "bag", "marks"])


def marks(words: np.ndarray) -> np.ndarray:
    """16 bits of every word with its occurrence number in the text; none of a text of more than ``MARK_WORDS`` words."""
    if len(words) > MARK_WORDS:
        return np.empty(0, "<u2")
    return (_mix(_occurrences(words.astype(_U), np.zeros(len(words), np.int64))) >> _U(48)).astype("<u2")


def _spare_words(of: list[bytes], x: np.ndarray, y: np.ndarray, least: np.ndarray) -> np.ndarray:
    """How many words beyond ``least`` pairs (``x, y``: places in ``of``, the texts' ``marks``) may share at most; 0 where marks are missing.

    Equal words have equal marks, so a text shares no more words with another
    than it has marks that are among the other's.
    """
    out, order = np.zeros(len(x), np.int64), np.argsort(x, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], x[order][1:] != x[order][:-1]))) if len(x) else []
    for at in np.split(order, first[1:]) if len(x) else ():
        if not (own := of[x[at[0]]]):
            continue
        there = np.zeros(1 << 16, np.uint8)
        there[np.frombuffer(own, "<u2")] = 1
        at = at[[bool(of[j]) for j in y[at]]]
        for lo in range(0, len(at), 128):
            part = at[lo:lo + 128]
            others = [of[j] for j in y[part]]
            begin = np.concatenate(([0], np.cumsum([len(o) // 2 for o in others])[:-1]))
            out[part] = np.add.reduceat(there[np.frombuffer(b"".join(others), "<u2")], begin, dtype=np.int64) - least[part]
    return out


def _cell_pairs(batches, similarity: float):
    """Pairs ``a, b, closest`` of rows ``band, value, i, j, own, doc, label, n, bag, marks`` sorted by cell (the first four).

    Every edit takes one word of a text away and brings one at most: of texts
    near each other neither has more than the allowed number of words that
    the other lacks. Each distance between two places is one step for all
    cells of a batch; what passes the ``bag`` is held against the ``marks``.
    ``closest``: the pair with most words to spare of one of its classes in
    the cell.
    """
    held = None

    def pairs(rows, bags, of):
        first = np.flatnonzero(np.concatenate(([True], (rows[1:, :4] != rows[:-1, :4]).any(axis=1))))
        end = np.repeat(np.append(first[1:], len(rows)), np.diff(np.append(first, len(rows))))
        left, right, least, x, d = [], [], [], np.arange(len(rows)), 0
        while len(x):
            d += 1
            x = x[x + d < end[x]]
            u = x[(rows[x, 6] != rows[x + d, 6]) & ((rows[x, 2] == rows[x, 3]) | (rows[x, 4] != rows[x + d, 4]))]
            longer = np.maximum(rows[u, 7], rows[u + d, 7])
            limit = (longer * (1 - similarity) + 1e-9).astype(np.int64)
            near = np.abs(rows[u, 7] - rows[u + d, 7]) <= limit
            u, limit, longer = u[near], limit[near], longer[near]
            for lo in range(0, len(u), 4096):
                v, most = u[lo:lo + 4096], limit[lo:lo + 4096]
                gap = bags[v].astype(np.int16) - bags[v + d]
                passed = (np.maximum(gap, 0).sum(axis=1) <= most) & (np.maximum(-gap, 0).sum(axis=1) <= most)
                left.append(v[passed])
                right.append(v[passed] + d)
                least.append((longer[lo:lo + 4096] - most)[passed])
        left, right, least = (np.concatenate(c or [np.empty(0, np.int64)]) for c in (left, right, least))
        spare = _spare_words(of, left, right, least)
        left, right, spare = (c[spare >= 0] for c in (left, right, spare))
        cell, closest = np.searchsorted(first, left, "right"), np.zeros(len(left), bool)
        cells, labels, of_pair = np.tile(cell, 2), np.concatenate((rows[left, 6], rows[right, 6])), np.tile(np.arange(len(left)), 2)
        order = np.lexsort((-spare[of_pair], labels, cells))
        new = np.ones(len(order), bool)
        new[1:] = (labels[order][1:] != labels[order][:-1]) | (cells[order][1:] != cells[order][:-1])
        closest[of_pair[order[new]]] = True
        a, b = rows[left, 5], rows[right, 5]
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b), closest], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64()), pa.array(found[:, 2] == 1, pa.bool_())],
                                          ["a", "b", "closest"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(8)], axis=1)
        bags = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8).reshape(batch.num_rows, BAG)
        of = batch.column(9).to_pylist()
        if held is not None:
            rows, bags, of = np.concatenate([held[0], rows]), np.concatenate([held[1], bags]), held[2] + of
        # the last cell may go on in the next batch
        cut = int(np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))[-1]) + 1 if (rows[0, :4] != rows[-1, :4]).any() else 0
        held = rows[cut:].copy(), bags[cut:].copy(), of[cut:]
        if cut:
            yield pairs(rows[:cut], bags[:cut], of[:cut])
    if held is not None:
        yield pairs(*held)


def components(edges: DataFrame) -> DataFrame:
    """``doc, label`` of every end of an edge (``a, b``): the smallest id of its connected class.

    Each round takes the smallest label of the neighbours and then the label
    of that label; every round is written, and one number (how many labels
    changed) comes to the driver.
    """
    both = written(edges.union(edges.select("b", "a")).toDF("u", "v"), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")).withColumnRenamed("u", "doc"), "labels")
    while True:
        around = both.join(labels, both["v"] == labels["doc"]).groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(around, labels["doc"] == around["u"]).select(
            "doc", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = written(step, "labels-step")
        jump = step.select(F.col("doc").alias("_d"), F.col("label").alias("_l"))
        new = written(step.join(jump, step["label"] == jump["_d"]).select("doc", F.least("label", "_l").alias("label"), "old"), "labels")
        labels = new.drop("old")
        if not new.where(F.col("label") != F.col("old")).limit(1).count():
            return labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
            bands: int = BANDS, length: int = LENGTH) -> DataFrame:
    """``doc, text_hash, class_id, kept`` for every distinct text with words under an id, written.

    ``class_id`` is the smallest id of the class; ``kept`` is true for one
    text of the class, under that id.
    """
    with scratch(docs.sparkSession):
        rows = written(sketch_rows(docs, id_col, text_col, bands, length).withColumn("node", F.monotonically_increasing_id()), "sketches")
        # equal word sequences are one node, known by the smallest of their rows' numbers; texts stay where they are
        copies = rows.groupBy("h1", "h2").agg(F.min("doc").alias("rep"), F.min("node").alias("node"), F.count(F.lit(1)).alias("rows"))
        copies = written(copies, "copies")
        others = written(rows.select("node", "h1", "h2").join(copies.where("rows > 1").select("h1", "h2", F.col("node").alias("first")), ["h1", "h2"])
                         .where("node <> first").select("node"), "copied-rows")
        reps = rows.join(others, "node", "left_anti").select(F.col("node").alias("doc"), "n", "sketch", "agree", "tokens")
        near = linked(reps, similarity).select(F.col("doc").alias("node"), "label")
        named = copies.join(near, "node", "left").select("h1", "h2", "rep", F.coalesce("label", "node").alias("label"))
        ids = named.groupBy("label").agg(F.min("rep").alias("class_id"))
        named = written(named.join(ids, "label").select("h1", "h2", "label", "class_id"), "named")
        texts = rows.select("doc", "text_hash", "h1", "h2").distinct().join(named, ["h1", "h2"])
        # among several texts of a class under its smallest id the one with the smallest hash stays
        texts = written(texts.select("doc", "text_hash", "label", "class_id"), "texts")
        first = texts.where(F.col("doc") == F.col("class_id")).groupBy("label").agg(F.min("text_hash").alias("_first"))
        found = texts.join(first, "label").select(
            "doc", "text_hash", "class_id", ((F.col("doc") == F.col("class_id")) & (F.col("text_hash") == F.col("_first"))).alias("kept"))
        return read_back(found, shared_path(docs.sparkSession, "classes"))


def _with_classes(docs: DataFrame, kept: list[Column], id_col: str, text_col: str, how: dict) -> DataFrame:
    found = classes(docs, id_col, text_col, **how).withColumnRenamed("kept", "_kept").withColumnRenamed("class_id", "_class")
    d = docs.select(*kept, doc_key(id_col, text_col).alias("_key"), text_hash(text_col).alias("_hash"))
    return d.join(found, (F.col("_key") == F.col("doc")) & (F.col("_hash") == F.col("text_hash")), "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept`` (it is the one of its class that stays)."""
    d = _with_classes(docs, [F.col(id_col).cast("long").alias("doc_id")], id_col, text_col, how)
    return d.select("doc_id", F.coalesce("_class", "_key").alias("class_id"), F.coalesce("_kept", F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that stay: one row of each class and all without words, with all columns as they came."""
    d = _with_classes(docs, [F.struct(*[docs[c] for c in docs.columns]).alias("_doc")], id_col, text_col, how)
    # repeated rows have one verdict: one of them stays, while every row without words is one of its own
    d = d.where(F.coalesce("_kept", F.lit(True))).withColumn("_own", F.when(F.col("_kept").isNull(), F.monotonically_increasing_id()))
    return d.dropDuplicates(["_key", "_hash", "_own"]).select("_doc.*")
