"""Conversation repair, BPE with word ends and periodic runs against brute force, the library and edge cases."""

import hashlib
import heapq
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shoprank.llm import convrepair, prefixbpe, runs
from shoprank.llm.oracle import SQL

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


# --- conversations

def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault) by Dijkstra over (rows used, state) with (cost, audit) as key."""
    expected, after = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, s, out = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in (0, 3):
            return cost, audit, out
        heapq.heappush(heap, (cost + 2, audit + "I", i, after[s], (*out, expected[s] + ":")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s, out))
        if fault not in ("blank", "duplicate"):
            cut = fault == "truncated"
            heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, after[s], (*out, f"{expected[s]}:{text}")))
            to = 1 if s == 0 and role[:1] == "s" else after[s] if role[:1] == expected[s][0] else None
            if to is not None:
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, to, (*out, f"{role}:{text}")))


def repaired(table):
    conversations = {}
    for conv, turn, role, text in table:
        held = conversations.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if d == 1 else text.translate({ord(c): None for c in ".!?"}) if d == 2 else text
        held += [(turn, "user" if d == 4 else role, text)] * {0: 0, 3: 2}.get(d, 1)
    out = set()
    for conv, held in conversations.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns, rows = {t for t, _, _ in held if t is not None}, []
        for i, (_, role, text) in enumerate(held):
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in {r[1:] for r in held[:i]} else "" if bare[-1] in ".!?" else "truncated"
            rows.append((role, text, fault))
        cost, audit, lines = cheapest(rows)
        faults = [f for _, _, f in rows]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.add((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                 illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def talk():
    """Conversations of the test table and made-up ones with nulls, ties, odd roles, repeats and one long one."""
    rnd = random.Random(5)
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    for c in range(10_000, 10_250):
        rows += [(c, rnd.choice([t, t, t, t + 1, None, t * 3]), rnd.choice(["user", "assistant", "system", None, "", "tool", "u2"]),
                  rnd.choice(["a.", "b", "", "  \n", "Yes!  ", "c?\t", None, "more text"])) for t in range(rnd.randrange(9))]
    rows += [(20_000, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["x.", f"{t}.", f"{t}"])) for t in range(700)]
    return rows + [(None, 0, "user", "Hi."), (None, 1, "assistant", "x"), (None, None, None, None), (None, None, None, None)]


def test_repair_equals_brute_force_and_sql(spark, talk):
    want = repaired(talk)
    df = spark.createDataFrame([(*r, "x", 1) for r in talk], "conv_id long, turn long, role string, text string, audit string, kind int")
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in convrepair.report(convrepair.damaged(df)).select(cols).collect()} == want
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    con = duckdb.connect()
    con.register("conversations", pa.table({k: pa.array(v, t) for k, v, t in zip(("conv_id", "turn", "role", "text"), zip(*talk), types)}))
    assert set(con.sql(SQL["op11_conversation_repair"]).select(", ".join(cols)).fetchall()) == want


def test_repair_of_rows_and_very_long_text(spark):
    long = "word " * 200_000 + "end."
    df = spark.createDataFrame([(1, 0, "assistant", long, 1), (1, 1, "system", "s.", 1), (1, 2, "user", "q?", 1), (2, 0, "user", "gone.", 0)],
                               "conv_id long, turn long, role string, text string, copies int")
    plan = convrepair.plan_repairs(df)
    got = [tuple(r) for r in convrepair.apply_repairs(df, plan).orderBy("conv_id", "place").collect()]
    cost, audit, lines = cheapest([("assistant", long, ""), ("system", "s.", ""), ("user", "q?", "")])
    assert [f"{r[3]}:{r[4]}" for r in got] == list(lines)
    assert {(r["conv_id"], r["cost"], r["audit"]) for r in plan.collect()} == {(1, cost, audit), (2, 0, "")}


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert convrepair.report(convrepair.damaged(df)).collect() == []


def test_a_long_conversation_is_cut_over_tasks(spark):
    """Chunks of one conversation from several tasks give the signature of the whole, gaps included."""
    rows = [(7, t // 2 * 3, "user" if t % 2 else "assistant", f"{t}.", 1) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    pieces = convrepair.signature_pieces(convrepair.narrow_rows(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = convrepair.signatures(pieces).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    order = sorted(rows, key=lambda r: (r[1], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    assert [(r["gaps"], r["raw"]) for r in one] == [(1499 * 3 + 1 - 1500, "".join("A" if r[2] == "user" else "E" for r in order))]


def test_nodes_of_a_common_suffix_are_computed_once():
    walk, built = convrepair.SuffixWalk(), []
    insert = walk._insert
    walk._insert = lambda cost, edit: (built.append(1), insert(cost, edit))
    for back in ("aua", "auau", "auaus", "auU"):
        walk.read(back)
    assert len(built) == 6


# --- BPE with word ends

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(prefixbpe.vocabulary_path())


def same(coder, library, text, **kw):
    ids = coder.encode(text, **kw)
    want = library.encode(text, add_special_tokens=False).ids
    return np.frombuffer(ids, "<u4").tolist() == want and coder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_equals_the_library(library):
    coder, rnd = prefixbpe.coder(prefixbpe.vocabulary_path()), random.Random(1)
    pool = ["a", "b", "e", "th", "in", "er", "  ", "\n", "<|endoftext|>", "<|startoftext|>", "<|endof", "é", "é", "ΑΣ", "İ",
            "中文", "한국", "\U0001F600", "\U0001f1e9", "“q”", "don't", "'S", "12", "½", "　", "\x85", "\x1c", "\x0b",
            "ß", "ﬁ", "ǅ", "ꟑ", "ᛖ8", "\U0003fc3b", "!!!", "—", " ", "ab" * 9, "ͅ", "́", "ẞ", "ֈ"]
    for _ in range(2500):
        assert same(coder, library, "".join(rnd.choice(pool) for _ in range(rnd.randrange(14))), chunk=6)
    for _ in range(4000):
        assert same(coder, library, "".join(rnd.choice("aabcdeinstheo'") for _ in range(rnd.randrange(30))))
    assert same(coder, library, "".join(rnd.choice("abcdeinstheo") for _ in range(50_000)))
    assert same(coder, library, "a" * 20_000 + " " + "é" * 20_000)


def test_bpe_documents(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (None, "No id here.", "x"), (5, "same Text", "x"), (5, "same Text", "x"),
            (6, "long words " * 30_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    digest = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(library.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(str, map(tuple, prefixbpe.encode_documents(df).collect()))) == sorted(map(str, want))
    back = {r["doc_id"]: r["text"] for r in prefixbpe.decode_documents(prefixbpe.encode_documents(df, digests=False)).collect()}
    assert back[1] == "" and back[5] == "same</w> text</w>"
    assert prefixbpe.encode_documents(df.limit(0)).collect() == []


def test_suffix_automaton_lists_all_strings_that_end():
    strings = [b"a", b"b", b"ab", b"bab", b"abab", b"cb"]
    auto = prefixbpe.SuffixAutomaton([(i, list(s)) for i, s in enumerate(strings)])
    text, at, held = b"cababbabcbab", 0, 0
    for i, c in enumerate(text):
        while c not in auto.step[at] and at:
            at = auto.link[at]
            held = auto.length[at]
        at, held = (auto.step[at][c], held + 1) if c in auto.step[at] else (0, 0)
        found = {strings[t] for n, t in auto.ends[at] if n <= held}
        assert found == {s for s in strings if text[:i + 1].endswith(s)}


# --- periodic runs

def brute_runs(words, least=6, times=4):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rnd, total = random.Random(3), 0
    for _ in range(250):
        texts = []
        for _ in range(rnd.randrange(1, 8)):
            k = rnd.choice([1, 2, 3, 10, 100])
            w = [rnd.randrange(k) for _ in range(rnd.randrange(80))]
            for _ in range(rnd.randrange(4)):
                block = [rnd.randrange(k) for _ in range(rnd.randrange(1, 9))]
                at = rnd.randrange(len(w) + 1)
                w[at:at] = (block * 50)[:rnd.randrange(1, 50)]
            texts.append(w)
        for w, got in zip(texts, runs.runs_of([np.array(w, np.int64) for w in texts])):
            want = brute_runs(w)
            total += len(want)
            assert [tuple(r) for r in got.tolist()] == want
    assert total > 500


def test_extensions_equal_brute_force():
    rnd = random.Random(9)
    for k in (1, 2, 5):
        text = np.array([rnd.randrange(k) for _ in range(400)] + [k], np.int64)
        a = np.array([rnd.randrange(400) for _ in range(600)])
        b = np.array([rnd.randrange(400) for _ in range(600)])
        a, b = a[a != b], b[a != b]

        def brute(i, j):
            n = 0
            while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
                n += 1
            return n

        assert runs.extensions(runs.grammar(text), a, b).tolist() == [brute(i, j) for i, j in zip(a.tolist(), b.tolist())]


def test_run_queries_and_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate([None, "", " \n ", "a " * 5, "a " * 6, "a b " * 4, "x y z " * 3, "q " + "r s t " * 9 + "v"])]
    rows += [(None, "a " * 9, "x"), (50, "long loop of words " * 20_000, "x"), (51, "dup dup dup dup dup dup dup", "x"),
             (51, "dup dup dup dup dup dup dup", "x")] + [(i, f"one two three four five {i} seven eight nine", "x") for i in range(60, 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(map(str, map(tuple, runs.with_digests(runs.periodic_runs(df, prepare=runs.looped)).collect())))
    want = []
    for i, t, _ in rows:
        w = (t or "").split()
        if i is not None and (h := zlib.crc32(str(i).encode())) % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
        found = brute_runs(w) if len(w) < 1000 else [(0, len(w), 4)]
        gone = {j for s, n, q in found for j in range(s + q, s + n)}
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        want.append((i, len(found), *best, best[1] * 1000 // best[2] if found else None,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
                     hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    assert zlib.crc32(b"50") % 10 and got == sorted(map(str, want))
    assert runs.periodic_runs(df.limit(0)).collect() == []
