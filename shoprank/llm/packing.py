"""Token ids and packed binary output (operator 8).

Documents become id sequences and are packed into rows of ``seq_len`` ids by
best-fit decreasing: longest first, each into the row with the least room
that still holds it. The row is found in a segment tree over capacities (one
leaf per amount of room, inner nodes tell whether any row below has it), so a
segment costs ``log2(seq_len)`` steps however many rows are open. A document
longer than a row is split into full rows and a remainder; nothing is cut off.

Packing runs inside each scan task over windows of about ``window`` ids: no
shuffle, memory bounded by the window, and only the last rows of a window
stay partly empty.

Written per row (Parquet): ``ids`` (little-endian uint32, padded to
``seq_len``: one line of the id matrix), ``n_tokens``, ``cu_seqlens``
(cumulative segment lengths, from 0), ``resets`` (one bit per place, set
where the position starts again at 0), and per segment ``doc_ids`` and
``chunks`` (place in its document).

The tokenizer is a parameter: byte-level BPE by a local rank file (the
default), UTF-8 bytes, or any other that gives ids. Its ``end`` id follows
each document, its ``pad`` id fills the rows.

Defined results: a null text is the empty text and gives one segment with
the end id alone; repeated rows are packed each; null ids stay null in
``doc_ids``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import shared_path, small_batches

ID = np.dtype("<u4")
SEQ_LEN = 8192
WINDOW = 6_000_000

SCHEMA = ("part long, win long, row long, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, chunks array<int>, "
          "resets binary, ids binary")


@dataclass(frozen=True)
class Tokenizer:
    """Ids of a text (``encode``, run inside the tasks), the id after each document, and the id of empty places."""

    encode: Callable[[str | None], np.ndarray]
    end: int
    pad: int


def byte_tokenizer() -> Tokenizer:
    """UTF-8 bytes as ids."""
    return Tokenizer(lambda text: np.frombuffer((text or "").encode(), np.uint8), 256, 257)


def bpe_tokenizer(path: str | None = None, pattern: str | None = None) -> Tokenizer:
    """Byte-level BPE by a rank file; ``end`` and ``pad`` follow its largest rank."""
    import public_tokenizers

    path, pattern = path or bpe.rank_path(), pattern or public_tokenizers.PATTERN
    size = bpe.encoder(path, pattern).n_vocab
    return Tokenizer(lambda text: bpe.encode(bpe.encoder(path, pattern), text), size, size + 1)


def ended(tokenizer: Tokenizer, text: str | None) -> np.ndarray:
    """The text's ids and the end id."""
    return np.append(tokenizer.encode(text), tokenizer.end).astype(ID)


class CapacityTree:
    """Which amounts of room (0 to ``top``) some open row has; finds the least one that is large enough."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.leaves
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` with the least room of at least ``need``; None if there is none."""
        i = need + self.leaves
        if not self.any[i]:
            while True:  # up to the first right neighbour that has something
                if i & (i + 1) == 0 or i <= 1:  # the right edge of the tree
                    return None
                if not i & 1 and self.any[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.leaves:  # down to its leftmost leaf
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            while i and not (i < self.leaves and (self.any[2 * i] or self.any[2 * i + 1])):
                self.any[i] = 0
                i >>= 1
        return room, row


def best_fit(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Rows as lists of segment numbers: best-fit decreasing, ties in order of arrival."""
    tree, rows = CapacityTree(seq_len), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found = (seq_len, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], row)
    return rows


def pack_window(docs: list[tuple], seq_len: int, pad: int):
    """Packed rows of ``(doc_id, ids)``: ``n_tokens, cu_seqlens, doc_ids, chunks, resets, ids`` each."""
    segments = [(d, k // seq_len, ids[k:k + seq_len]) for d, ids in docs for k in range(0, len(ids), seq_len)]
    for members in best_fit([len(s[2]) for s in segments], seq_len):
        parts = [segments[i] for i in members]
        cu = np.concatenate(([0], np.cumsum([len(p[2]) for p in parts])))
        line = np.full(seq_len, pad, ID)
        line[:cu[-1]] = np.concatenate([p[2] for p in parts])
        resets = np.zeros(seq_len, bool)
        resets[cu[:-1]] = True
        yield int(cu[-1]), cu.tolist(), [p[0] for p in parts], [p[1] for p in parts], np.packbits(resets).tobytes(), line.tobytes()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN, window: int = WINDOW,
         tokenizer: Tokenizer | None = None) -> DataFrame:
    """Packed rows of all documents; ``(part, win, row)`` names a row. The tokenizer is BPE where none is given."""
    tokenizer = tokenizer or bpe_tokenizer()
    schema = pa.schema([("part", pa.int64()), ("win", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int32()),
                        ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("chunks", pa.list_(pa.int32())),
                        ("resets", pa.binary()), ("ids", pa.binary())])

    def run(batches):
        part = TaskContext.get().partitionId()
        held, size, win = [], 0, 0

        def flush():
            row, out = 0, []
            for r in pack_window(held, seq_len, tokenizer.pad):
                out.append((part, win, row, *r))
                row += 1
                if len(out) * seq_len >= 2_000_000:
                    yield out
                    out = []
            if out:
                yield out

        def arrow(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for b in small_batches(batches):
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = ended(tokenizer, t.as_py())
                held.append((d, ids))
                size += len(ids)
                if size >= window:
                    yield from map(arrow, flush())
                    held, size, win = [], 0, win + 1
        yield from map(arrow, flush())

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, path: str | None = None, **how) -> str:
    """Write the packed rows as Parquet (Zstandard) to ``path`` or a new shared folder; returns the path."""
    path = path or shared_path(docs.sparkSession, "packed")
    pack(docs, **how).write.option("compression", "zstd").parquet(path)
    return path


def positions(cu_seqlens: list[int], seq_len: int) -> np.ndarray:
    """Position ids of a row: from 0 in every segment, 0 in the padding."""
    out = np.zeros(seq_len, np.int32)
    for a, b in zip(cu_seqlens, cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def segments(packed: DataFrame) -> DataFrame:
    """``part, win, row, doc_id, chunk, ids`` of every segment of packed rows."""
    p = packed.select("part", "win", "row", "cu_seqlens", "ids", F.posexplode(F.arrays_zip("doc_ids", "chunks")).alias("k", "s"))
    a, b = F.element_at("cu_seqlens", F.col("k") + 1), F.element_at("cu_seqlens", F.col("k") + 2)
    return p.select("part", "win", "row", F.col("s.doc_ids").alias("doc_id"), F.col("s.chunks").alias("chunk"),
                    F.substring("ids", ID.itemsize * a + 1, ID.itemsize * (b - a)).alias("ids"))
