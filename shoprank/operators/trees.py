"""Histogram trees grown by Spark passes over a binned matrix: boosting, forests, node tables.

Data
    ``binned`` turns feature columns into one byte per feature (quantile bins,
    the last one for missing values) and writes them with the targets, one
    role per model (train, validation, none) and the running predictions.
    The number of files follows the size.

Growing
    A level of all trees of all models is one pass: every task adds up
    histograms (rows and target sums per model, node, feature and bin) of its
    rows and the partial sums are added by a shuffle keyed by model and block
    of features, whose tasks return only the best split of every node. Where the
    partial sums of all tasks are few (``DIRECT_BYTES``) they go to the driver
    directly, as in a tree aggregation. What reaches the driver is bounded by models,
    nodes, features and bins, never by rows. A split sends missing values to
    the side with the larger gain. Targets may be vectors: the gain is summed
    over them, so one forest serves several labels.

    Boosting adds up the smaller child of a node only: the driver keeps the
    sums of a level's nodes (up to ``KEPT_BYTES``; beyond that every node is
    added up and only splits return) and takes the larger child as what is
    left. Differences from the running predictions are rounded to a fixed
    point (``_scale``), so sums are exact, whatever the tasks and their order.

Boosting
    All models (targets, folds, bags) advance round by round in the same
    passes. Its matrix is written in chunks of up to ``CHUNK_BYTES``, feature by
    feature, that tasks read as they are. Running predictions are written every ``block`` (10) rounds; in between
    tasks apply the block's trees themselves, feature by feature over the rows
    of a chunk that they add up, so every pass is a read of one written table and a lost executor costs its own tasks. The squared error
    on each model's validation rows comes with the first pass of a round. A
    model stops when ``patience`` rounds have brought nothing better and keeps
    the trees up to its best round.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_back, remove_path, shared_path

TRAIN, VALIDATION = 1, 2
FILE_BYTES, TASK_BYTES, SMALL_BYTES = 64 << 20, 2 << 20, 64 << 10
#: Partial sums of a pass that may go to the driver directly.
DIRECT_BYTES = 24 << 20
#: Sums of the nodes of two levels that the driver may keep, and the size of a chunk of a boosting matrix.
KEPT_BYTES, CHUNK_BYTES = 256 << 20, 8 << 20
FEW_TASKS = 4
FEATURE_BLOCK = 32
SKETCH_BLOCK = 16
BATCH_ROWS = 4096


@dataclass(frozen=True)
class Shape:
    """How trees grow: at most ``2 ** depth`` leaves of ``min_rows`` rows at least."""

    depth: int = 5
    min_rows: float = 20
    min_gain: float = 1e-9
    bins: int = 64
    seed: int = 2018
    row_fraction: float = 0.8     # of the rows, drawn anew every ``row_every`` trees
    row_every: int = 5
    feature_fraction: float = 0.9  # of the features, drawn per tree
    features_per_node: int | None = None
    bootstrap: bool = False        # Poisson(1) weights per tree instead of a fraction of the rows


@dataclass
class Tree:
    """Nodes of one tree as parallel lists; ``feature`` is -1 at a leaf, ``cut`` the last bin that goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def add(self, cover: float, value: np.ndarray) -> int:
        for x, v in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.gain, self.cover, self.value),
                        (-1, 0, False, -1, -1, 0.0, cover, value)):
            x.append(v)
        return len(self.feature) - 1

    def frozen(self) -> Tree:
        """The same tree with arrays in place of lists, small to send."""
        of = dict(feature=np.int32, cut=np.int32, missing_left=bool, left=np.int32, right=np.int32, gain=float, cover=float, value=float)
        return Tree(**{k: np.array(getattr(self, k), t) for k, t in of.items()})

    def leaves_of(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """Leaf of every row of a binned matrix."""
        return self.leaves(np.ascontiguousarray(bins.T), missing, len(bins))

    def leaves(self, columns: np.ndarray, missing: int, rows: int) -> np.ndarray:
        """Leaf of every row of a binned matrix given feature by feature: the rows of a node are dealt to its children."""
        out = np.zeros(rows, np.int32)
        todo = [(0, None)]
        while todo:
            node, at = todo.pop()
            f = int(self.feature[node])
            if f < 0:
                if at is None:
                    out[:] = node
                else:
                    out[at] = node
                continue
            side = np.arange(256) <= self.cut[node]
            side[missing] = self.missing_left[node]
            go_left = side[columns[f] if at is None else columns[f][at]]
            for child, chosen in ((int(self.left[node]), go_left), (int(self.right[node]), ~go_left)):
                some = np.flatnonzero(chosen) if at is None else at[chosen]
                if len(some):
                    todo.append((child, some))
        return out

    def reached(self, columns: np.ndarray, missing: int, rows: np.ndarray, wanted: Sequence[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """The leaves (or the ``wanted`` nodes) that some of ``rows`` reach, each with its rows."""
        if wanted is not None and not wanted:
            return
        on_way = None
        if wanted is not None:
            above = {int(c): n for n in range(len(self.feature)) for c in (self.left[n], self.right[n]) if c >= 0}
            on_way = set()
            for n in wanted:
                while n is not None and n not in on_way:
                    on_way.add(n)
                    n = above.get(n)
        todo = [(0, rows)]
        while todo:
            node, at = todo.pop()
            f = int(self.feature[node])
            if f < 0 or (wanted is not None and node in wanted):
                yield node, at
                continue
            x = columns[f][at]
            go_left = x <= self.cut[node]
            if self.missing_left[node]:
                go_left |= x == missing
            for child, chosen in ((int(self.left[node]), go_left), (int(self.right[node]), ~go_left)):
                if on_way is None or child in on_way:
                    some = at[chosen]
                    if len(some):
                        todo.append((child, some))


@dataclass
class Ensemble:
    """Models of one fit: ``trees[m]`` per model, first value and the edges of the features' bins."""

    columns: list[str]
    edges: list[np.ndarray]
    first: np.ndarray
    trees: list[list[Tree]]
    rate: float = 1.0
    errors: list[list[float]] = field(default_factory=list)  # validation error after each number of trees, per model

    @property
    def missing(self) -> int:
        return max(map(len, self.edges), default=0) + 1

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Predictions of every model (rows x models); a model's trees are added up."""
        columns = np.ascontiguousarray(bins.T)
        out = np.tile(self.first, (len(bins), 1))
        for m, trees in enumerate(self.trees):
            now = out[:, m].copy()
            for t in trees:
                now += self.rate * t.value[:, 0][t.leaves(columns, self.missing, len(bins))]
            out[:, m] = now
        return out


# --- the binned matrix

def bin_edges(df: DataFrame, cols: list[str], bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each column: distinct quantiles of its values, without the largest.

    One pass; a row becomes one row per block of ``SKETCH_BLOCK`` columns, not
    one per column, and the bounded sketches are merged by block.
    """
    if not cols:
        return []
    value = [F.col(f"`{c}`").cast("double") for c in cols]
    value = [F.when(~F.isnan(v), v) for v in value] + [F.lit(None).cast("double")] * (-len(cols) % SKETCH_BLOCK)
    parts = [F.struct(F.lit(lo).alias("lo"), *[value[lo + k].alias(f"v{k}") for k in range(SKETCH_BLOCK)]) for lo in range(0, len(cols), SKETCH_BLOCK)]
    each = df.select(F.explode(F.array(*parts)).alias("x")).select("x.*")
    at = [k / bins for k in range(1, bins)]
    found = each.groupBy("lo").agg(*[f(f"v{k}") for k in range(SKETCH_BLOCK) for f in (lambda v: F.percentile_approx(v, at, 10000), F.max)])
    out = [np.empty(0)] * len(cols)
    for lo, *got in found.collect():
        for i, q, top in zip(range(lo, len(cols)), got[::2], got[1::2]):
            out[i] = np.array(sorted({x for x in q or () if x < top}))
    return out


def to_bins(columns: list[np.ndarray], edges: list[np.ndarray], missing: int) -> np.ndarray:
    """Bins of the values of each feature (float arrays, NaN is missing) as rows x features bytes."""
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.uint8)
    for j, (x, e) in enumerate(zip(columns, edges)):
        out[:, j] = np.where(np.isnan(x), missing, np.searchsorted(e, x, side="left"))
    return out


def _floats(b: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [b.column(j).to_numpy(zero_copy_only=False).astype(float) for j in range(n)]


def binned(df: DataFrame, cols: list[str], edges: list[np.ndarray], key: str, targets: list[Column], roles: list[Column],
           first: list[float]) -> DataFrame:
    """Rows ``key (hash), bins, y, role, f`` of a matrix: targets, one role per model, the running predictions."""
    missing = max(map(len, edges), default=0) + 1
    if missing > 255:
        raise ValueError("at most 254 bins")
    n = len(cols)

    def run(batches):
        for b in batches:
            rows = to_bins(_floats(b, n), edges, missing) if n else np.empty((b.num_rows, 0), np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(n), pa.array([r.tobytes() for r in rows], pa.binary()), *[b.column(n + i) for i in (1, 2, 3)]],
                                             ["key", "bins", "y", "role", "f"])

    feats = [F.col(f"`{c}`").cast("double").alias(f"_x{j}") for j, c in enumerate(cols)]
    rest = [F.xxhash64(key).alias("key"), F.array(*[t.cast("double") for t in targets]).alias("y"),
            F.array(*[r.cast("int") for r in roles]).alias("role"), F.array(*[F.lit(float(x)) for x in first]).alias("f")]
    return df.select(*feats, *rest).mapInArrow(run, "key long, bins binary, y array<double>, role array<int>, f array<double>")


def packed(rows: DataFrame, features: int, row_bytes: int) -> DataFrame:
    """The rows of ``binned`` as chunks: every column of a chunk is one value, feature by feature, target by target, model by model."""
    most = max(1, CHUNK_BYTES // row_bytes)

    def chunk(held):
        b = pa.Table.from_batches(held).combine_chunks()
        key, bins, y, role, f = (b.column(i).combine_chunks() for i in range(5))
        out = [key.to_numpy().astype(np.int64), _bin_columns(bins, features), _numbers(y).T, np.nan_to_num(_numbers(role).T).astype(np.uint8), _numbers(f).T]
        return pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in out]],
                                          ["rows", "key", "bins", "y", "role", "f"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, most):
                held.append(b.slice(lo, most))
                n += held[-1].num_rows
                if n >= most:
                    yield chunk(held)
                    held, n = [], 0
        if n:
            yield chunk(held)

    return rows.mapInArrow(run, "rows int, key binary, bins binary, y binary, role binary, f binary")


def _chunks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Key, bins by feature, targets, roles and running predictions of every chunk; the bins are not copied."""
    for b in batches:
        _, at, data = b.column(2).buffers()
        at = np.frombuffer(at, np.int32)[b.column(2).offset:]
        for i in range(b.num_rows):
            n = b.column(0)[i].as_py()
            bins = np.frombuffer(data, np.uint8, features * n, int(at[i])) if features * n else np.empty(0, np.uint8)
            key, y, role, f = (np.frombuffer(b.column(j)[i].as_buffer(), t) for j, t in ((1, np.int64), (3, float), (4, np.uint8), (5, float)))
            yield key, bins.reshape(features, n), y.reshape(-1, n), role.reshape(-1, n), f.reshape(-1, n)


def _file_rows(path: str) -> Iterator[pa.RecordBatch]:
    """The rows of a Parquet file that a task opens itself."""
    with pq.ParquetFile(path) as f:
        for k in range(f.num_row_groups):
            yield from f.read_row_group(k, use_threads=False).to_batches()


class Matrix:
    """A binned matrix written under the checkpoint folder; ``files`` follows its size, ``pack`` is what is made of their rows.

    In a folder of the machines' own file system (shared by the driver and all executors) a task of ``map`` opens one
    file itself, which spares the way through the JVM; elsewhere the rows come from Spark's reader.
    """

    def __init__(self, rows: DataFrame, row_bytes: int, pack: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path = rows.sparkSession, shared_path(rows.sparkSession, "binned")
        self.paths, self.step, self.schema, self.table, self.own = [self.path + "-0"], 0, rows.schema, None, None
        rows.write.parquet(self.paths[0])
        size = self.df().count() * row_bytes
        cores = max(FEW_TASKS, self.spark.sparkContext.defaultParallelism)
        self.files = max(1, math.ceil(size / FILE_BYTES), min(cores, size // TASK_BYTES), min(FEW_TASKS, size // SMALL_BYTES))
        if self.files > cores:
            self.files += -self.files % cores
        whole = self.df().repartition(self.files)
        self.write(pack(whole) if pack else whole)

    def df(self) -> DataFrame:
        if self.table is None:
            self.table = self.spark.read.schema(self.schema).parquet(self.paths[-1])
        return self.table

    def map(self, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
        """``run`` over the rows of every file."""
        if self.own is None:
            names = sorted(self.df().inputFiles())
            self.own = [unquote(urlparse(x).path) for x in names] if all(urlparse(x).scheme in ("", "file") for x in names) else []
        paths = self.own
        if not paths:
            return self.df().mapInArrow(run, schema)

        def each(batches):
            return run(x for b in batches for i in b.column(0).to_pylist() for x in _file_rows(paths[i]))

        return self.spark.range(0, len(paths), 1, len(paths)).mapInArrow(each, schema)

    def write(self, rows: DataFrame) -> None:
        """The next state of the table; the one before is deleted."""
        self.step += 1
        path = f"{self.path}-{self.step}"
        rows.write.parquet(path)
        self.paths.append(path)
        self.schema, self.table, self.own = rows.schema, None, None
        remove_path(self.spark, self.paths.pop(0))

    def remove(self) -> None:
        for p in self.paths:
            remove_path(self.spark, p)


# --- one pass

@dataclass
class Work:
    """What the tasks of a pass need: the block's finished trees, the growing ones and the open nodes of each model."""

    shape: Shape
    models: list[int]
    done: dict[int, list[Tree]]
    grow: dict[int, Tree]
    open: dict[int, list[int]]
    turn: int
    rate: float
    features: int
    missing: int
    classes: list[int] | None = None  # class targets: the first column of each label's classes, then their number
    errors: bool = False
    scale: list[float] = field(default_factory=list)  # units of a model's fixed point in 1 (boosting)
    kept: bool = False  # the driver keeps the sums of open nodes
    count: dict[int, list[int]] = field(default_factory=dict)  # nodes that tasks add up
    rest: dict[int, dict[int, tuple[int, int]]] = field(default_factory=dict)  # the parent and the other child of such a node

    @property
    def width(self) -> int:
        """Sums per cell: rows, then one per target (boosting has one per model)."""
        return 2 if self.classes is None else 1 + self.classes[-1]


def _uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Hash of the keys to [0, 1), by salt."""
    x = key.astype(np.uint64)
    for s in salt:
        x = (x ^ np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def row_weights(key: np.ndarray, shape: Shape, model: int, turn: int) -> np.ndarray:
    """Weight of every row in a tree: 0 or 1 by the row fraction, or a Poisson(1) draw."""
    if not shape.bootstrap:
        return (_uniform(key, shape.seed, model, turn // shape.row_every) < shape.row_fraction).astype(float)
    u, out, p, total = _uniform(key, shape.seed, model, turn), np.zeros(len(key)), math.exp(-1), 0.0
    for k in range(1, 12):
        total += p
        out += u >= total
        p /= k
    return out


def chosen_features(work: Work, model: int, node: int) -> np.ndarray:
    """Features that a node may split on: a fraction per tree, or some per node."""
    s, n = work.shape, work.features
    per_node = s.features_per_node
    rng = np.random.default_rng([s.seed, model, work.turn, node if per_node else 0])
    k = per_node or max(1, round(s.feature_fraction * n))
    return rng.permutation(n)[:min(k, n)]


def _numbers(column: pa.ListArray) -> np.ndarray:
    """An Arrow list column whose lists are equally long, as rows x values (floats, null is NaN)."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def _bin_columns(column: pa.BinaryArray, features: int) -> np.ndarray:
    """The bytes of the rows, feature by feature."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return np.ascontiguousarray(raw.reshape(len(column), features).T)


def _class_sums(batches: Iterator[pa.RecordBatch], work: Work) -> Iterator[tuple[int, np.ndarray, float, float]]:
    """Histograms of one task of a forest per tree."""
    n_f, n_b, width = work.features, work.missing + 1, work.width
    hist = {m: np.zeros((len(work.count[m]) * n_f * n_b, width)) for m in work.models}
    for whole in batches:
        for lo in range(0, whole.num_rows, BATCH_ROWS):  # the class sums have a place per row and feature at once
            b = whole.slice(lo, BATCH_ROWS)
            rows = b.num_rows
            key = b.column(0).to_numpy()
            columns = _bin_columns(b.column(1), n_f)
            y, role = (_numbers(b.column(i)) for i in (2, 3))
            for m in work.models:
                of = role[:, min(m, role.shape[1] - 1)]
                if not work.count[m]:
                    continue
                slot = np.full(len(work.grow[m].feature), -1)
                slot[work.count[m]] = np.arange(len(work.count[m]))
                at = slot[work.grow[m].leaves(columns, work.missing, rows)]
                w = row_weights(key, work.shape, m, work.turn)
                use = np.flatnonzero((of == TRAIN) & (at >= 0) & (w > 0))
                if not len(use):
                    continue
                cells = (np.arange(n_f) * n_b)[:, None] + columns[:, use]
                cell = (at[use] * (n_f * n_b) + cells).T.ravel()
                weight, size = np.repeat(w[use], n_f), len(hist[m])
                hist[m][:, 0] += np.bincount(cell, weight if work.shape.bootstrap else None, size)
                flat = hist[m].reshape(-1)
                for j in range(y.shape[1]):
                    place = cell * width + 1 + work.classes[j] + np.repeat(y[use, j].astype(np.int64), n_f)
                    np.add.at(flat, place, weight)
    for m in work.models:
        yield m, hist[m].reshape(len(work.count[m]), n_f, n_b, width), 0.0, 0.0


def _boost_sums(batches: Iterator[pa.RecordBatch], work: Work) -> Iterator[tuple[int, np.ndarray, float, float]]:
    """Histograms of one task per model, with squared error and number of its validation rows.

    The block's trees are applied to the rows that count only.
    """
    hist = {m: np.zeros((len(work.count[m]), work.features, work.missing + 1, 2)) for m in work.models}
    error = {m: np.zeros(2) for m in work.models}
    used = {m: _used_features(work, m) for m in work.models}
    for key, columns, y, role, f in _chunks(batches, work.features):
        for m in work.models:
            of, target, now = role[min(m, len(role) - 1)], y[min(m, len(y) - 1)], f[m].copy()
            use = np.flatnonzero(of == TRAIN) if work.count[m] else np.empty(0, np.int64)
            w = row_weights(key[use], work.shape, m, work.turn)
            if work.shape.bootstrap:
                weight = np.zeros(len(key))
                weight[use] = w
            parts = dict(work.grow[m].reached(columns, work.missing, use[w > 0], work.count[m]))
            slots = [i for i, n in enumerate(work.count[m]) if n in parts]
            use = np.concatenate([parts[work.count[m][i]] for i in slots]) if slots else use[:0]
            at = np.repeat(slots, [len(parts[work.count[m][i]]) for i in slots]).astype(np.int64)
            val = np.flatnonzero(of == VALIDATION) if work.errors else use[:0]
            rows = np.concatenate([use, val])
            for t in work.done[m]:
                for leaf, some in t.reached(columns, work.missing, rows):
                    now[some] += work.rate * t.value[leaf, 0]
            error[m] += ((target[val] - now[val]) ** 2).sum(), len(val)
            if len(use):
                gap = np.rint((target[use] - now[use]) * work.scale[m])
                _add_columns(hist[m], columns, used[m], use, at, gap, weight[use] if work.shape.bootstrap else None)
    for m in work.models:
        hist[m][..., 1] /= work.scale[m]
        yield m, hist[m], *error[m].tolist()


def _used_features(work: Work, model: int) -> np.ndarray:
    """The features that tasks add up: those of the tree where the driver keeps whole sums, else all."""
    return np.sort(chosen_features(work, model, 0)) if work.kept and not work.shape.features_per_node else np.arange(work.features)


def _add_columns(hist: np.ndarray, columns: np.ndarray, used: np.ndarray, use: np.ndarray, at: np.ndarray, gap: np.ndarray,
                 w: np.ndarray | None) -> None:
    """Add the rows ``use`` to the counts and target sums of their nodes, one feature after the other: its cells fit the cache.

    Where the rows are many to the cells, two features are added up together by their pairs of bins.
    """
    nodes, _, n_b, _ = hist.shape
    every = len(use) == columns.shape[1] and nodes == 1
    gap = gap if w is None else gap * w
    both = len(use) >= 4 * nodes * n_b * n_b
    base, cell = at * (n_b * n_b if both else n_b), np.empty(len(use), np.intp)
    for k in range(0, len(used), 2 if both else 1):
        j = used[k:k + 2] if both else used[k:k + 1]
        code = columns[j[0]] if every else columns[j[0]][use]
        if len(j) == 2:
            code = code.astype(np.uint16) * np.uint16(n_b) + (columns[j[1]] if every else columns[j[1]][use])
        if nodes > 1:
            np.add(at * n_b if both and len(j) == 1 else base, code, out=cell)
        else:
            cell[:] = code
        size = nodes * n_b ** len(j)
        for x, weight in enumerate((w, gap)):
            sums = np.bincount(cell, weight, size)
            if len(j) == 2:
                sums = sums.reshape(nodes, n_b, n_b)
                hist[:, j[0], :, x] += sums.sum(axis=2)
                hist[:, j[1], :, x] += sums.sum(axis=1)
            else:
                hist[:, j[0], :, x] += sums.reshape(nodes, n_b)


def best_splits(hist: np.ndarray, work: Work, model: int, lo: int = 0) -> list[tuple | None]:
    """The best split of each open node over the features from ``lo`` on that a histogram covers.

    ``(gain, feature, cut, missing_left, sums left, sums right)``; among equal
    gains the one with missing values on the right, then the first feature and
    cut. None where no split leaves ``min_rows`` on both sides.
    """
    out: list[tuple | None] = []
    for i, cells in enumerate(hist):
        total = _total(cells, work, model)
        held = cells[:, :-1].cumsum(axis=1)
        best = None
        allowed = np.zeros(work.features, bool)
        allowed[chosen_features(work, model, work.open[model][i])] = True
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = (total[1:] ** 2).sum() / total[0]
            for side, left in ((False, held), (True, held + cells[:, -1:])):
                right = total - left
                gain = (left[..., 1:] ** 2).sum(axis=-1) / left[..., 0] + (right[..., 1:] ** 2).sum(axis=-1) / right[..., 0] - whole
                ok = (left[..., 0] >= work.shape.min_rows) & (right[..., 0] >= work.shape.min_rows) & allowed[lo:lo + len(cells), None]
                gain = np.where(ok, gain, -np.inf)
                j, t = np.unravel_index(gain.argmax(), gain.shape)
                if gain[j, t] > max(work.shape.min_gain, best[0] * (1 + 1e-12) if best else 0):
                    best = (float(gain[j, t]), lo + int(j), int(t), side, left[j, t].copy(), right[j, t].copy())
        out.append(best)
    return out


def _total(cells: np.ndarray, work: Work, model: int) -> np.ndarray:
    """The sums of a node, over the bins of the first feature that was added up."""
    return cells[_used_features(work, model)[0] if work.kept else 0].sum(axis=0)


def run_pass(matrix: Matrix, work: Work, kept: dict[int, dict[int, np.ndarray]]) -> tuple[dict[int, list], dict[int, list], dict[int, tuple[float, int]]]:
    """Best splits and totals of every open node, and the validation errors, of all models.

    ``kept`` holds the sums of the level before by model and node and gets those of this level, where the driver keeps them.
    """
    models = work.models

    def partial(batches):
        rows = []
        for m, hist, sse, n in (_boost_sums if work.classes is None else _class_sums)(batches, work):
            for lo in range(0, max(1, work.features), FEATURE_BLOCK):
                rows.append((m, lo, hist[:, lo:lo + FEATURE_BLOCK].tobytes(), sse if not lo else 0.0, n if not lo else 0.0))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.float64()))],
                                         ["model", "lo", "sums", "sse", "n"])

    def shaped(m: int, lo: int, raw: bytes) -> np.ndarray:
        k = min(FEATURE_BLOCK, work.features - lo)
        return np.frombuffer(raw).reshape(len(work.count[m]), k, work.missing + 1, work.width)

    def choose(batches):
        held: dict[tuple[int, int], list] = {}
        for b in batches:
            for m, lo, raw, sse, n in zip(*(b.column(i).to_pylist() for i in range(5))):
                part = shaped(m, lo, raw)
                old = held.get((m, lo))
                held[m, lo] = [part.copy(), sse, n] if old is None else [old[0] + part, old[1] + sse, old[2] + n]
        rows = [(m, lo, h.tobytes() if work.kept else pickle.dumps((best_splits(h, work, m, lo), [c[0].sum(axis=0) for c in h])), sse, n)
                for (m, lo), (h, sse, n) in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in
                                          enumerate((pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.float64()))], ["model", "lo", "sums", "sse", "n"])

    schema = "model int, lo int, sums binary, sse double, n double"
    parts = matrix.map(partial, schema)
    nodes = sum(len(work.count[m]) for m in models)
    many = matrix.files > 1 and matrix.files * nodes * work.features * (work.missing + 1) * work.width * 8 > DIRECT_BYTES
    if many:
        parts = parts.repartition("model", "lo").mapInArrow(choose, schema)
    chosen = many and not work.kept
    splits, totals, errors, held = {m: [None] * len(work.open[m]) for m in models}, {}, {m: [0.0, 0.0] for m in models}, {}
    got = parts.toArrow()  # the sums come as Arrow sends them, not as rows
    for m, lo, raw, sse, n in sorted(zip(*(got.column(i).to_pylist() for i in range(5)))):
        errors[m] = [errors[m][0] + sse, errors[m][1] + n]
        if chosen:
            held[m, lo] = pickle.loads(raw)
        else:
            held[m, lo] = held[m, lo] + shaped(m, lo, raw) if (m, lo) in held else shaped(m, lo, raw)
    if work.kept:
        held = {(m, 0): _with_rest(np.concatenate([h for (x, _), h in sorted(held.items(), key=lambda e: e[0]) if x == m], axis=1), work, m, kept[m])
                for m in models if work.open[m]}
    for m, lo in sorted(held):
        best, total = held[m, lo] if chosen else (best_splits(held[m, lo], work, m, lo), [_total(c, work, m) for c in held[m, lo]])
        totals.setdefault(m, total)
        for i, s in enumerate(best):
            if s and (splits[m][i] is None or (-s[0], s[3]) < (-splits[m][i][0], splits[m][i][3])):
                splits[m][i] = s
    return splits, totals, {m: (e[0], e[1]) for m, e in errors.items()}


def _with_rest(sums: np.ndarray, work: Work, model: int, kept: dict[int, np.ndarray]) -> np.ndarray:
    """The sums of all open nodes from those that were added up: the other child is what is left of the parent. ``kept`` goes on to this level."""
    now = dict(zip(work.count[model], sums))
    for node, (parent, other) in work.rest[model].items():
        now[other] = kept[parent] - now[node]
    kept.clear()
    kept.update({n: now[n] for n in work.open[model]})
    return np.stack(list(kept.values()))


def grow_trees(matrix: Matrix, work: Work) -> tuple[dict[int, Tree], dict[int, tuple[float, float]]]:
    """One tree per model of ``work``, level by level; also the validation errors before them."""
    values = work.classes is None
    work.grow = {m: Tree() for m in work.models}
    for t in work.grow.values():
        t.add(0.0, np.zeros(1))
    work.open = work.count = {m: [0] for m in work.models}
    work.rest = {m: {} for m in work.models}
    work.kept = values and 2 * len(work.models) * 2 ** (work.shape.depth - 1) * work.features * (work.missing + 1) * 16 <= KEPT_BYTES
    kept: dict[int, dict[int, np.ndarray]] = {m: {} for m in work.models}
    errors: dict[int, tuple[float, float]] = {}
    for level in range(work.shape.depth):
        work.errors = level == 0 and values
        splits, totals, seen = run_pass(matrix, work, kept)
        errors = seen if level == 0 else errors
        work.open, work.count, before = {}, {}, work.open
        for m in work.models:
            tree, nodes, pairs = work.grow[m], [], {}
            for node, split, total in zip(before[m], splits[m], totals.get(m, [])):
                if level == 0:
                    tree.cover[0], tree.value[0] = float(total[0]), total[1:] / max(total[0], 1e-300)
                if split is None:
                    continue
                gain, feature, cut, side, left, right = split
                a, b = (tree.add(float(s[0]), s[1:] / s[0]) for s in (left, right))
                tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = feature, cut, side, gain
                tree.left[node], tree.right[node] = a, b
                both = [x for x, s in ((a, left), (b, right)) if s[0] >= 2 * work.shape.min_rows]
                nodes += both
                if both:
                    small, big = (a, b) if left[0] <= right[0] else (b, a)
                    pairs[small] = (node, big)
            work.open[m], work.count[m], work.rest[m] = nodes, list(pairs) if work.kept else nodes, pairs
        if not any(work.open.values()):
            break
    return {m: t.frozen() for m, t in work.grow.items()}, errors


# --- fits

def boost(df: DataFrame, cols: list[str], targets: list[Column], roles: list[Column], rounds: int = 100, patience: int | None = None,
          rate: float = 0.05, shape: Shape = Shape(), block: int = 10, key: str = "user_id") -> Ensemble:
    """Boosted regression trees (squared error) for several models at once.

    Model m learns ``targets[m]`` from the rows whose ``roles[m]`` is TRAIN
    (1), starting with their mean. With ``patience`` a model stops when so
    many rounds have not lowered the error on its VALIDATION (2) rows, and
    keeps its best number of trees; a model without such rows takes all
    ``rounds``. A model without training rows predicts 0.
    """
    models = range(len(targets))
    spark, path = df.sparkSession, shared_path(df.sparkSession, "train")
    t, r = ([F.col(f"_{x}{m}") for m in models] for x in "tr")
    try:
        df = read_back(df.select(key, *[f"`{c}`" for c in cols], *[x.cast("double").alias(f"_t{m}") for m, x in enumerate(targets)],
                                 *[x.cast("int").alias(f"_r{m}") for m, x in enumerate(roles)]), path)
        edges = bin_edges(df, cols, shape.bins)
        got = tuple(df.agg(*[f(F.when(r[m] == TRAIN, t[m])) for m in models for f in (F.avg, F.min, F.max, F.count)]).first())
        seen = [got[4 * m:4 * m + 4] for m in models]
        means, scale = [x[0] for x in seen], [_scale(*x[1:]) for x in seen]
        out = Ensemble(cols, edges, np.array([x or 0.0 for x in means]), [[] for _ in models], rate, [[] for _ in models])
        row_bytes = len(cols) + 24 * len(targets) + 16
        matrix = Matrix(binned(df, cols, edges, key, t, r, out.first.tolist()), row_bytes, lambda rows: packed(rows, len(cols), row_bytes))
    finally:
        remove_path(spark, path)
    start, live = 0, [m for m in models if means[m] is not None]
    best = {m: (math.inf, 0) for m in models}
    try:
        for turn in range(rounds + 1):
            if turn - start == block:
                _advance(matrix, out, start)
                start = turn
            last = turn == rounds
            if last and patience is None:
                break
            work = Work(shape, live, {m: out.trees[m][start:] for m in live}, {}, {}, turn, rate, len(cols), out.missing, scale=scale)
            if last:
                work.grow, work.errors = {m: Tree() for m in live}, True
                work.open = work.count = {m: [] for m in live}
                grown, errors = {}, run_pass(matrix, work, {})[2]
            else:
                grown, errors = grow_trees(matrix, work)
            for m in list(live):
                sse, n = errors[m]
                if n and patience is not None:
                    out.errors[m].append(sse / n)
                    if sse / n < best[m][0]:
                        best[m] = (sse / n, turn)
                    elif turn - best[m][1] >= patience:
                        live.remove(m)
                        continue
                if not last:
                    out.trees[m].append(grown[m])
            if not live:
                break
    finally:
        matrix.remove()
    if patience is not None:
        for m in models:
            if out.errors[m]:
                out.trees[m] = out.trees[m][:best[m][1]]
    return out


def _scale(lo: float | None, hi: float | None, rows: int) -> float:
    """Units in 1 of a fixed point whose sums over all rows are exact in a double, for differences up to four times the targets' range."""
    span = hi - lo if rows else 0.0
    return 2.0 ** (52 - math.ceil(math.log2(4 * rows * span))) if 0 < span < math.inf else 1.0


def _advance(matrix: Matrix, fitted: Ensemble, start: int) -> None:
    """Write the running predictions after the trees from ``start`` on."""
    block, n_f, missing, rate = [t[start:] for t in fitted.trees], len(fitted.columns), fitted.missing, fitted.rate

    def run(batches):
        for b in batches:
            new = []
            for _, columns, _, _, f in _chunks([b], n_f):
                f, rows = f.copy(), np.arange(f.shape[1])
                for now, trees in zip(f, block):
                    for t in trees:
                        for leaf, some in t.reached(columns, missing, rows):
                            now[some] += rate * t.value[leaf, 0]
                new.append(f.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(new, pa.binary())], b.schema.names)

    matrix.write(matrix.map(run, matrix.schema))


@dataclass
class Forest:
    """Trees for several class labels at once: a leaf holds the class shares of every label, one after the other."""

    columns: list[str]
    edges: list[np.ndarray]
    labels: list[str]
    classes: list[list[int]]
    trees: list[Tree]

    @property
    def offsets(self) -> list[int]:
        return [0, *np.cumsum([len(c) for c in self.classes]).tolist()]

    @property
    def missing(self) -> int:
        return max(map(len, self.edges), default=0) + 1

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """The class with the largest mean share of every label (rows x labels); the smallest of equal ones."""
        share = np.zeros((len(bins), self.offsets[-1]))
        for t in self.trees:
            share += t.value[t.leaves_of(bins, self.missing)]
        return np.stack([np.array(c)[share[:, a:b].round(9).argmax(axis=1)] for c, a, b in zip(self.classes, self.offsets, self.offsets[1:])], axis=1)


def class_forest(df: DataFrame, cols: list[str], labels: list[str], n_trees: int = 10, shape: Shape | None = None, key: str = "user_id",
                 most_classes: int = 4096) -> Forest:
    """One forest for all labels: the gain of a split is the fall of the Gini impurity summed over the labels.

    The distinct values of a label are its classes; more than ``most_classes``
    in all are refused, since the histograms hold a sum per class. All trees
    grow in the same passes, each on a Poisson bootstrap of the rows and with
    the square root of the features per node.
    """
    shape = shape or Shape(min_rows=1, bootstrap=True, features_per_node=max(1, round(math.sqrt(len(cols)))))
    spark, path = df.sparkSession, shared_path(df.sparkSession, "train")
    try:
        df = read_back(df.select(key, *[f"`{c}`" for c in cols], *[F.col(f"`{c}`").cast("long").alias(f"_l{i}") for i, c in enumerate(labels)]), path)
        many = df.agg(*[F.approx_count_distinct(f"_l{i}") for i in range(len(labels))]).first()
        if sum(many) > 2 * most_classes:
            raise ValueError(f"more than {most_classes} classes")
        classes = [list(v) for v in df.agg(*[F.sort_array(F.collect_set(f"_l{i}")) for i in range(len(labels))]).first()]
        if sum(map(len, classes)) > most_classes:
            raise ValueError(f"more than {most_classes} classes")
        edges = bin_edges(df, cols, shape.bins)
        out = Forest(cols, edges, labels, classes, [])
        code = [F.array_position(F.array(*[F.lit(v) for v in c]), F.col(f"_l{i}")) - 1 for i, c in enumerate(classes)]
        matrix = Matrix(binned(df, cols, edges, key, code, [F.lit(TRAIN)], []), len(cols) + 8 * len(labels) + 24)
    finally:
        remove_path(spark, path)
    work = Work(shape, list(range(n_trees)), {}, {}, {}, 0, 1.0, len(cols), out.missing, out.offsets)
    try:
        out.trees = list(grow_trees(matrix, work)[0].values())
    finally:
        matrix.remove()
    return out


# --- use of the fitted models

def with_predictions(df: DataFrame, model: Ensemble | Forest, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``, or all) with a prediction of each model (or label) under ``names``; no join, no shuffle."""
    keep = df.columns if keep is None else keep
    n, kind = len(model.columns), "long" if isinstance(model, Forest) else "double"
    arrow = pa.int64() if kind == "long" else pa.float64()

    def run(batches):
        for b in batches:
            bins = to_bins(_floats(b, n), model.edges, model.missing) if n else np.empty((b.num_rows, 0), np.uint8)
            p = model.predict(bins)
            yield pa.RecordBatch.from_arrays([*b.columns[n:], *[pa.array(p[:, i], arrow) for i in range(len(names))]],
                                             [*b.schema.names[n:], *names])

    feats = [F.col(f"`{c}`").cast("double").alias(f"_x{j}") for j, c in enumerate(model.columns)]
    held = [F.col(f"`{c}`") for c in keep]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*held).schema.fields)
    return df.select(*feats, *held).mapInArrow(run, ", ".join([kept, *[f"`{x}` {kind}" for x in names]]))


NODES = ("model string, tree int, node int, feature string, threshold double, missing_left boolean, gain double, cover double, "
         "left int, right int, value double")


def node_table(spark: SparkSession, model: Ensemble, names: list[str]) -> DataFrame:
    """The models as rows: inner nodes with feature, threshold (values up to it go left) and gain, leaves with their value.

    A prediction is the value of tree -1 plus the leaf values of the other trees.
    """
    rows: list[tuple] = []
    for name, first, trees in zip(names, model.first.tolist(), model.trees):
        rows.append((name, -1, 0, None, None, None, None, None, None, None, first))
        for i, t in enumerate(trees):
            value = (t.value[:, 0] * model.rate).tolist()
            for n, f, cut, side, gain, cover, left, right in zip(range(len(value)), *(x.tolist() for x in (
                    t.feature, t.cut, t.missing_left, t.gain, t.cover, t.left, t.right))):
                if f < 0:
                    rows.append((name, i, n, None, None, None, None, cover, None, None, value[n]))
                else:
                    edges = model.edges[f]
                    at = float(edges[cut]) if cut < len(edges) else math.inf
                    rows.append((name, i, n, model.columns[f], at, side, gain, cover, left, right, None))
    return spark.createDataFrame(rows, NODES)


def importance(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``model, name, splits, gain`` for every feature (0 where unused), most used first."""
    used = nodes.where(F.col("feature").isNotNull()).groupBy("model", F.col("feature").alias("name")).agg(
        F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    grid = nodes.select("model").distinct().select("model", F.explode(F.array(*[F.lit(c) for c in columns])).alias("name"))
    out = grid.join(used, ["model", "name"], "left").select(
        "model", "name", F.coalesce("splits", F.lit(0)).cast("long").alias("splits"), F.coalesce("gain", F.lit(0.0)).alias("gain"))
    return out.orderBy("model", F.desc("splits"), F.desc("gain"), "name")
