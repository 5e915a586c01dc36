"""Cheapest repair of conversation structure by a suffix-shared automaton (operator 11).

A conversation is right when its roles' initials read ``(s?(ua)+)?``: an
optional system row, then user and assistant in turn. Every row has at most
one fault: *blank* (no visible character), *duplicate* (role and text of an
earlier row) or *truncated* (its last visible character is none of ``.!?``).
Edits and their costs: keep K 0, change the role to the one expected R 2,
delete D 3 (blank and duplicate rows have to be), insert an empty row of the
expected role I 2; a truncated row that stays adds 1. Of the cheapest
sequences of edits the least in ASCII order is taken.

Method
    A conversation's *signature* has one symbol per row: the class of its
    role's initial and its fault. Signatures are sorted by their reversal and
    read in that order, so that those with a common suffix stand together:
    the automaton of all suffixes (a directed acyclic word graph built from
    the end) is walked with a stack, one node per suffix and symbol. In each
    node the cost to go and the best next edit are computed once for each
    of the four states of the grammar (start, after s, after u, after a), from
    the node behind it; a conversation reads its edits along these links. From
    a given state an edit's letter fixes what follows, so the least letter
    among the cheapest gives the least sequence. Rows that have to be deleted
    are one symbol whatever their role, which joins further nodes.

Scale
    Signatures come from narrow rows (ids, turn, 128-bit digest, symbol):
    equal rows of a conversation are counted first, then sorted by range over
    conversation, turn and digest, so a conversation with a large part of all
    rows is cut into chunks over many tasks; only its signature, one letter
    per row like the result's audit, is ever put together. Signatures are
    dealt by range of reversal and conversation, so a frequent one is spread
    over tasks too. Texts are shuffled once, to the edits of their
    conversation, and pass through each task as a sorted stream. The digest
    of a conversation is one chain over its whole text and so is taken by one
    task, as a stream that holds a row at a time. Intermediate tables are
    written under ``spark.checkpoint.dir``.

Defined results: a null role or text is one space, a null conversation id is
a conversation of its own, null turns come first; rows of equal turn are
ordered by a digest of role and text; repeated rows are duplicates of the
first; very long texts are kept whole; a conversation without rows has an
empty audit; an empty table gives no rows; only the four named columns are
read, so further and clashing columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import read_back, shared_path
from .common import ASCII_SPACE, scratch, small_batches, written

ENDS = (".", "!", "?")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Symbols of raw signatures: class of the initial (u, a, s, other) times fault (none, truncated, blank, duplicate).
RAW = "ABCDEFGHIJKLMNOP"
#: The same with all rows that have to be deleted as one symbol; a capital is a truncated row.
MINIMAL = "uUXXaAXXsSXXoOXX"
CLASSES = "uaso"
NONE, TRUNCATED, BLANK, DUPLICATE = range(4)

#: Grammar states: start, after s, after u, after a. The role expected in each and the state after it.
EXPECTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
FAR = 1 << 60

PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = "conv_id long, place long, edit string, role string, text string"


# --- rows

def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of ``conversations`` with planted faults, as ``conv_id, turn, role, text, copies``.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (0 copies), 1
    empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a
    user's. Nulls of role and text, and in the hashed key, are one space.
    """
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                                F.coalesce(F.col(role).cast("string"), space).alias("role"),
                                F.coalesce(F.col(text).cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_d", F.crc32(key.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn", F.when(F.col("_d") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_d") == 1, F.lit("")).when(F.col("_d") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_d") == 0, 0).when(F.col("_d") == 3, 2).otherwise(1).alias("copies"))


def _digest() -> Column:
    """128 bits of role and text."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def narrow_rows(rows: DataFrame) -> DataFrame:
    """Equal rows counted: ``conv_id, turn, digest, symbol, n`` with the symbol of the row by itself."""
    bare = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(*ENDS), NONE).otherwise(TRUNCATED)
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    there = F.col("copies") > 0
    one = rows.select("conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, _digest()).alias("digest"),
                      F.when(there, kind * 4 + fault).cast("int").alias("symbol"), F.col("copies").cast("long").alias("copies"))
    return one.groupBy("conv_id", "turn", "digest", "symbol").agg(F.sum("copies").alias("n"))


def signature_pieces(narrow: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, piece``: the raw symbols of each group of equal rows, duplicates marked.

    The first place of a digest within a conversation is sought only for
    digests that stand at several turns.
    """
    visible = narrow.where((F.col("n") > 0) & (F.col("symbol") % 4 != BLANK))
    again = (visible.groupBy(F.col("conv_id").alias("_c"), F.col("digest").alias("_g"))
             .agg(F.count(F.lit(1)).alias("_k"), F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_first")).where("_k > 1"))
    rows = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_g")), "left")
    first = F.col("_k").isNull() | F.when(F.col("_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("_first"))
    letter = [F.substring(F.lit(RAW), i + F.lit(1), F.lit(1))
              for i in (F.col("symbol"), F.col("symbol") - F.col("symbol") % 4 + DUPLICATE)]
    n = F.col("n").cast("int")
    piece = (F.when(n == 0, F.lit("")).when(F.col("symbol") % 4 == BLANK, F.repeat(letter[0], n))
             .when(first, F.concat(letter[0], F.repeat(letter[1], n - 1))).otherwise(F.repeat(letter[1], n)))
    return rows.select("conv_id", "turn", "digest", piece.alias("piece"))


def signatures(pieces: DataFrame) -> DataFrame:
    """``conv_id, gaps, raw``: the whole signature of every conversation, and the turns missing in it."""
    order = ["conv_id", "turn", "digest"]
    chunks = pieces.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "conv_id long, part int, raw string, lo long, hi long, turns long")
    whole = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "raw", "lo", "hi", "turns"))).alias("c"))
    with_turns = F.filter("c", lambda x: x["turns"] > 0)
    met = F.expr("size(filter(transform(sequence(1, size(t)), i -> i > 1 AND t[i - 1].lo = t[greatest(i - 2, 0)].hi), x -> x))")
    distinct = F.aggregate("t", F.lit(0).cast("long"), lambda s, x: s + x["turns"]) - met
    gaps = F.expr("element_at(t, -1).hi - t[0].lo + 1") - distinct
    return whole.withColumn("t", with_turns).select(
        "conv_id", F.when(F.size("t") > 0, gaps).otherwise(F.lit(0)).cast("long").alias("gaps"),
        F.array_join(F.transform("c", lambda x: x["raw"]), "").alias("raw"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces put together per conversation, with the first, last and number of its turns in this task."""
    names = ["conv_id", "part", "raw", "lo", "hi", "turns"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    part, now, held, done = TaskContext.get().partitionId(), None, None, []

    def flush():
        cols = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    for b in batches:
        for conv, turn, piece in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
            if now is None or conv != now[0]:
                if now is not None:
                    done.append((now[0], part, "".join(held), now[1], now[2], now[3]))
                    if len(done) >= 4096:
                        yield flush()
                        done = []
                now, held = [conv, None, None, 0], []
            held.append(piece)
            if turn is not None and piece and turn != now[2]:
                now[1:] = [turn if now[1] is None else now[1], turn, now[3] + 1]
    if now is not None:
        done.append((now[0], part, "".join(held), now[1], now[2], now[3]))
        yield flush()


# --- the automaton

def keep_state(state: int, symbol: str) -> int | None:
    """State after keeping a row of the class of ``symbol``, or None if the grammar forbids it."""
    s = symbol.lower()
    if s == "s" and state == 0:
        return 1
    return AFTER[state] if s == EXPECTED[state][0] else None


class SuffixWalk:
    """The nodes on the path of the signature read last: node d is its suffix of d symbols.

    ``cost[d][state]`` and ``edit[d][state]`` are the cost to go and the best
    next edit. Reading a signature keeps the nodes of the common suffix.
    """

    def __init__(self) -> None:
        self.path = ""
        cost, edit = [0, FAR, FAR, 0], [""] * 4
        self._insert(cost, edit)
        self.cost, self.edit = [cost], [edit]

    @staticmethod
    def _insert(cost: list[int], edit: list[str]) -> None:
        """Let rows be inserted before a node's own row, as long as that improves a state."""
        better = True
        while better:
            better = False
            for s in range(4):
                new = (INSERT + cost[AFTER[s]], "I")
                if new < (cost[s], edit[s]):
                    (cost[s], edit[s]), better = new, True

    def read(self, backwards: str) -> None:
        """Follow a minimal signature given from its end."""
        d = 0
        for x, y in zip(self.path, backwards):
            if x != y:
                break
            d += 1
        del self.cost[d + 1:], self.edit[d + 1:]
        for symbol in backwards[d:]:
            behind, cost, edit = self.cost[-1], [0] * 4, [""] * 4
            cut = CUT if symbol.isupper() else 0
            for s in range(4):
                best = (DELETE + behind[s], "D")
                if symbol != "X":
                    to = keep_state(s, symbol)
                    if to is not None:
                        best = min(best, (KEEP + cut + behind[to], "K"))
                    best = min(best, (REROLE + cut + behind[AFTER[s]], "R"))
                cost[s], edit[s] = best
            self._insert(cost, edit)
            self.cost.append(cost)
            self.edit.append(edit)
        self.path = backwards

    def result(self) -> tuple[int, str]:
        """Cost and edits of the signature read last."""
        d, s, out = len(self.path), 0, []
        while letter := self.edit[d][s]:
            out.append(letter)
            if letter == "I":
                s = AFTER[s]
                continue
            d -= 1
            if letter == "K":
                s = keep_state(s, self.path[d])
            elif letter == "R":
                s = AFTER[s]
        return self.cost[len(self.path)][0], "".join(out)


def counts(raw: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows of a raw signature, and its illegal neighbours."""
    codes = [RAW.index(c) for c in raw]
    fault = [c % 4 for c in codes]
    roles = "".join(CLASSES[c // 4] for c in codes)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return fault.count(BLANK), fault.count(DUPLICATE), fault.count(TRUNCATED), illegal


def plans(signed: DataFrame) -> DataFrame:
    """Counts, cost and edits of every conversation from its signature."""
    back = F.reverse(F.translate("raw", RAW, MINIMAL))
    dealt = signed.select("conv_id", "gaps", "raw", back.alias("back")).repartitionByRange("back", "conv_id").sortWithinPartitions("back", "raw")
    return dealt.mapInArrow(_plan, PLAN)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk, last, best, raw, stats = SuffixWalk(), None, (0, ""), "", (0, 0, 0, 0)
    for b in small_batches(batches, rows=4096):
        out = []
        for conv, gaps, now, back in zip(*(b.column(i).to_pylist() for i in range(4))):
            if back != last:
                walk.read(back)
                last, best = back, walk.result()
            if now != raw:
                raw, stats = now, counts(now)
            out.append((conv, gaps, *stats, *best))
        cols = list(zip(*out)) or [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.string())],
                                         [x.split()[0] for x in PLAN.split(", ")])


# --- repair

def plan_repairs(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of ``conv_id, turn, role, text, copies``, written.

    A conversation whose rows all have 0 copies is reported as empty.
    """
    spark = rows.sparkSession
    with scratch(spark):
        narrow = written(narrow_rows(rows), "conversation-rows")
        pieces = written(signature_pieces(narrow), "conversation-pieces")
        signed = written(signatures(pieces), "conversation-signatures")
        return read_back(plans(signed), shared_path(spark, "conversation-plans"))


def apply_repairs(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired conversations as ``conv_id, place, edit, role, text``; a task's rows come sorted by conversation and place."""
    body = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", _digest().alias("digest"), "role", "text", "copies")
    head = planned.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).alias("copies"))
    stream = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
    return stream.select("conv_id", "kind", "role", "text", "copies").mapInArrow(_repair, REPAIRED)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the repaired conversations from the sorted stream of edits and rows."""
    conv, audit, at, state, place = None, "", 0, 0, 0
    for b in small_batches(batches, rows=1024):
        for now, kind, role, text, copies in zip(*(b.column(i).to_pylist() for i in range(5))):
            if kind == 0:
                for letter in audit[at:]:  # rows inserted at the end
                    yield conv, place, letter, EXPECTED[state], ""
                    state, place = AFTER[state], place + 1
                conv, audit, at, state, place = now, text, 0, 0, 0
                continue
            for _ in range(copies):
                while audit[at] == "I":
                    yield conv, place, "I", EXPECTED[state], ""
                    at, state, place = at + 1, AFTER[state], place + 1
                letter, at = audit[at], at + 1
                if letter == "D":
                    continue
                if letter == "R":
                    role, state = EXPECTED[state], AFTER[state]
                    yield conv, place, letter, role, text
                else:
                    yield conv, place, letter, role, text
                    state = keep_state(state, role[:1])
                place += 1
    for letter in audit[at:]:
        yield conv, place, letter, EXPECTED[state], ""
        state, place = AFTER[state], place + 1


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    held, size = [], 0
    for row in _edits(batches):
        held.append(row)
        size += len(row[4])
        if len(held) >= 4096 or size >= 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the rows ``role:text`` joined by line feeds, from :func:`apply_repairs` as it stands."""

    def run(batches):
        conv, chain, started = None, None, False
        for b in small_batches(batches, rows=1024):
            ids, out = [], []
            for now, place, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if place == 0:
                    if started:
                        ids.append(conv)
                        out.append(chain.hexdigest())
                    conv, chain, started = now, hashlib.sha256(), True
                else:
                    chain.update(b"\n")
                chain.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["conv_id", "repaired_sha256"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([chain.hexdigest()], pa.string())],
                                             ["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def report(rows: DataFrame) -> DataFrame:
    """Plan and digest of every conversation of ``rows``, one row each."""
    planned = plan_repairs(rows)
    done = digests(apply_repairs(rows, planned)).withColumnRenamed("conv_id", "_conv")
    joined = planned.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)))
