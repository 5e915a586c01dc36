"""Edge cases and brute-force comparisons of the training-data operators on small fixtures."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprank.llm import bpe, htmltext, linededup, mih, mixing, neardup, packing, quality, toxicity, warc
from shoprank.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, host string, key string"


def docs(spark, rows):
    """Rows (doc_id, text, source) with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, very long, repeated and hostile rows."""
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    return docs(spark, [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, long, "a"), (4, long, "a"), (None, "no id here", "b"),
                        (6, "é" * 3000, "b"), (7, "one two three " * 40, "\U0001F600"), (8, "x\n" * 500, "")])


# --- search

def hamming(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def brute_top_k(codes, k):
    out = set()
    for q, c in codes:
        if c is not None and q is not None and q % 50 == 0:
            near = sorted((hamming(c, d), i) for i, d in set(codes) if d is not None and i is not None and i != q)[:k]
            out |= {(q, r + 1, i, dist) for r, (dist, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("kind", ["random", "clustered", "equal"])
def test_top_k_is_exact(spark, kind):
    rnd = random.Random(kind)
    if kind == "random":
        codes = [(i, rnd.getrandbits(64) - 2**63) for i in range(400)]
    elif kind == "clustered":
        codes = [(i, rnd.choice([5, 2**40, -7]) ^ (1 << rnd.randrange(60))) for i in range(300)]
    else:
        codes = [(i, 42) for i in range(120)] + [(50, 42), (200, None), (None, 1)]
    df = spark.createDataFrame(codes, "id long, code long")
    got = {tuple(r) for r in mih.top_k(df, df.where("id % 50 = 0"), k=5).collect()}
    assert got == brute_top_k(codes, 5)


def test_top_k_broadcasts_neither_probes_nor_hits(spark, monkeypatch):
    plans, write = [], mih.written
    monkeypatch.setattr(mih, "written", lambda df, name, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name, *a))
    df = spark.createDataFrame([(i, (i * 0x9E3779B97F4A7C15) % (1 << 63)) for i in range(400)], "id long, code long")
    out = mih.top_k(df, df.where("id % 50 = 0"), k=5)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 4 and not any("Broadcast" in p for p in plans)
    assert out.count() == 40


def test_top_k_empty_and_codes(spark):
    df = spark.createDataFrame([], "id long, code long")
    assert mih.top_k(df, df).count() == 0
    v = spark.createDataFrame([(1, [0.5, -1.0, None, 2.0] + [0.0] * 59 + [1.0]), (2, None), (3, [1.0])], "id long, v array<float>")
    codes = {r["id"]: r["c"] for r in v.select("id", mih.sign_code(F.col("v")).alias("c")).collect()}
    assert codes == {1: (1 | 8) - 2**63, 2: None, 3: 1}


# --- quality rules

def brute_base(text):
    words = [w for w in (text or "").encode().split()]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").encode().split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return len(words), len(hit), dup


def test_base_counts_match_brute_force():
    rnd = random.Random(2)
    for _ in range(60):
        text = "".join(rnd.choice(["a ", "b ", "c ", "\n", "\x0b", "é ", "#$ "]) for _ in range(rnd.randrange(60)))
        n, chars, symbols, dup, rep = quality.base_counts(text)
        assert (n, rep, dup) == brute_base(text)
        assert chars == sum(len(w.decode()) for w in text.encode().split())
        assert symbols == sum(c in quality.SYMBOLS for c in text)


def test_quality_rows_and_hosts(spark, odd):
    rows = quality.judge(odd).collect()
    assert len(rows) == 9 and all(r["kept"] is not None for r in rows)
    assert not any(r["kept"] for r in rows if r["base_failed"])
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    many = docs(spark, [(i, bad if i % 10 else good, "junk") for i in range(200)] + [(1000 + i, good, "fine") for i in range(200)]
                + [(5000, good, None)])
    got = {r["doc_id"]: r["kept"] for r in quality.judge(many).collect()}
    assert not any(got[i] for i in range(200)) and all(got[1000 + i] for i in range(200)) and got[5000]
    kept = quality.keep(many)
    assert kept.columns == many.columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k}
    assert quality.judge(odd.limit(0)).count() == 0 and quality.keep(odd.limit(0)).count() == 0


def test_beta_prior_shrinks_small_hosts():
    mean, strength = quality.beta_prior(3, 300, 60, 3 * 100.0**2, (5**2 + 15**2 + 40**2) / 100)
    assert mean == 0.2 and 1 <= strength < 100
    assert quality.beta_prior(1, 10, 5, 100.0, 2.5) == (0.5, 10_000.0)
    assert quality.beta_prior(0, 0, 0, 0.0, 0.0) == (0.0, 1.0)


# --- mixing

def test_mix_reaches_targets(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 60)), rnd.choice(["a", "b", "c", None, "d"] + ["a"] * 6)) for i in range(3000)]
    df = docs(spark, rows)
    got = mixing.mix(df, bucket_rows=100).collect()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(df.repartition(3), bucket_rows=100).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    source = {i: s for i, _, s in rows}
    by = {}
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        t = by.setdefault(source[r["doc_id"]], [r["target"], r["source_size"], 0])
        t[2] += r["taken"]
    total = sum(t[1] for t in by.values())
    assert abs(sum(t[0] for t in by.values()) - 1.5 * total) < 1e-3
    for target, size, taken in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 60
    # one bucket or many: the same documents
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(df).collect()} == again
    copies = {r["doc_id"]: r["count"] for r in mixing.repeat_mixed(df).groupBy("doc_id").count().collect()}
    assert copies == {r["doc_id"]: r["times"] for r in mixing.mix(df).collect() if r["times"]}


def test_mix_odd_rows(spark, odd):
    got = mixing.mix(odd).collect()
    assert len(got) == 9 and all(r["taken"] is not None for r in got)
    assert mixing.mix(odd.limit(0)).count() == 0
    nothing = docs(spark, [(1, "", "a"), (2, None, None)])
    assert [r["taken"] for r in mixing.mix(nothing).collect()] == [0, 0]
    assert mixing.repeat_mixed(odd).columns == odd.columns


# --- line dedup

def brute_lines(rows):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    first = {}
    order = lambda i: (1 << 63) - 1 if i is None else i
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 10 or first[key(x)] == order(i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 3), (5, 2), (8, 3)])
def test_line_dedup_matches_brute_force(spark, batches, fanout):
    rnd = random.Random(batches)
    pool = [f"A shared line No {i} of the pool" for i in range(12)] + ["short", "", " \t", "  A SHARED line no 3 of the pool\r"]
    rows = [(rnd.choice([None] + list(range(90))), "\n".join(rnd.choice(pool + [f"own line {i} {rnd.random()}"]) for _ in range(rnd.randrange(9))), "s")
            for i in range(80)] + [(95, None, "s"), (96, "", "s")]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in
           linededup.dedup_lines(docs(spark, rows), batches=batches, fanout=fanout).select("_doc.doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=str) == brute_lines(rows)


def test_line_dedup_odd_rows(spark, odd):
    out = linededup.dedup_lines(odd).select("_doc.*", "n_lines", "kept").collect()
    assert len(out) == 9 and all(r["n_lines"] >= 1 and r["kept"] is not None for r in out)
    assert linededup.dedup_lines(odd.limit(0)).count() == 0


# --- near-duplicates

def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + [0] * len(b), row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_banded_distance_matches_full_table():
    rnd = random.Random(8)
    for _ in range(300):
        a = [rnd.randrange(5) for _ in range(rnd.randrange(40))]
        b = list(a)
        for _ in range(rnd.randrange(12)):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(3)] = [rnd.randrange(5) for _ in range(rnd.randrange(3))]
        true, limit = brute_distance(a, b), rnd.randrange(0, 15)
        x, y = np.array(a, "<u4"), np.array(b, "<u4")
        assert neardup.distance(x, y, limit) == min(true, limit + 1)
        if len(a) and len(b):
            assert neardup._banded_rows(x, y, limit) == min(true, limit + 1)
            assert neardup._bit_columns(neardup.places(x), len(x), y, limit) == min(true, limit + 1)


def test_occurrence_labels_keep_repeated_kmers_apart():
    k = np.array([7, 9, 7, 7, 9, 1], np.uint64)
    out = neardup._occurrences(k, np.array([0, 0, 0, 1, 1, 1]))
    assert len(set(out[:3].tolist())) == 3 and out[0] == out[3] == 7 and out[1] == out[4]


def test_word_hashes_do_not_depend_on_place():
    words = [b"alpha", b"b", "é".encode(), b"alpha"]
    a, _ = neardup.word_hashes(np.frombuffer(b" ".join(words), np.uint8))
    b, starts = neardup.word_hashes(np.frombuffer(b"\n\n" + b"\t ".join(words) + b" ", np.uint8))
    assert a.tolist() == b.tolist() and a[0] == a[3] and len(set(a.tolist())) == 3 and starts[0] == 2
    old, neardup._PIECE = neardup._PIECE, 8
    try:
        c, _ = neardup.word_hashes(np.frombuffer(b" ".join(words) + b" " + b"z" * 50, np.uint8))
        d, _ = neardup.word_hashes(np.frombuffer(b"z" * 50, np.uint8))
    finally:
        neardup._PIECE = old
    assert c[:4].tolist() == a.tolist() and c[4] == d[0]


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(11)
    vocab = [f"word{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(60):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(90, 200))]
        rows.append(base)
        for _ in range(rnd.choice([0, 0, 1, 3])):
            near = list(base)
            for _ in range(max(1, len(near) // 60)):
                near[rnd.randrange(len(near))] = rnd.choice(vocab)
            rows.append(near)
        if i % 4 == 0:
            rows.append(passage + [rnd.choice(vocab) for _ in range(150)])
    rows += [list(rows[0]), list(rows[0])]
    rnd.shuffle(rows)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = max(len(rows[i]), len(rows[j]))
            if n - sum(x == y for x, y in zip(rows[i], rows[j])) <= n and neardup.similar(
                    *(np.array([int(w[4:]) for w in rows[k]], "<u4") for k in (i, j))):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    df = docs(spark, [(i, " ".join(w).upper() if i % 7 == 0 else " \n".join(w), "s") for i, w in enumerate(rows)])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == {i: find(i) for i in range(len(rows))}
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in range(len(rows))})


def near_classes(groups):
    """Smallest id of the class of every text, all pairs of a group compared; ``groups`` hold ``(id, words)``."""
    out = {}
    for group in groups:
        label = {i: i for i, _ in group}
        for k, (i, x) in enumerate(group):
            for j, y in group[:k]:
                if label[i] != label[j] and neardup.similar(*(np.array([int(w[4:]) for w in t], "<u4") for t in (x, y))):
                    a, b = sorted((label[i], label[j]))
                    label = {n: a if c == b else c for n, c in label.items()}
        out |= label
    return out


@pytest.mark.parametrize("copies,trials", [(2, 100), (20, 12), (100, 3)])
def test_texts_linked_by_one_that_is_near_all(spark, copies, trials):
    """An original and copies with another block each replaced, near it but not each other; its id first, last or any."""
    rnd = random.Random(copies)
    groups, top = [], 0
    for trial in range(trials):
        base = [f"word{rnd.randrange(10**6)}" for _ in range(300)]
        texts = [base]
        for c in range(copies):
            at = c * (300 - 36) // max(1, copies - 1)
            texts.append(base[:at] + [f"word{rnd.randrange(10**6)}" for _ in range(36)] + base[at + 36:])
        ids = list(range(top, top + len(texts)))
        if trial % 3:
            rnd.shuffle(ids)
            if trial % 3 == 1:  # the original last
                k = ids.index(max(ids))
                ids[0], ids[k] = ids[k], ids[0]
        top += len(texts)
        groups.append(list(zip(ids, texts)))
    df = docs(spark, [(i, " ".join(t), "s") for g in groups for i, t in g])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == near_classes(groups)


def test_moved_paragraphs_keep_their_links(spark):
    """Copies with one paragraph moved agree in most bands; some are near one another, some are not."""
    rnd = random.Random(6)
    groups, top = [], 0
    for _ in range(20):
        base = [f"word{rnd.randrange(10**6)}" for _ in range(300)]
        texts = [base]
        for size in (24, 27, 30, 45, 60, 90):
            at = rnd.randrange(300 - size)
            cut = base[:at] + base[at + size:]
            to = rnd.randrange(len(cut))
            texts.append(cut[:to] + base[at:at + size] + cut[to:])
        ids = list(range(top, top + len(texts)))
        rnd.shuffle(ids)
        top += len(texts)
        groups.append(list(zip(ids, texts)))
    df = docs(spark, [(i, " ".join(t), "s") for g in groups for i, t in g])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == near_classes(groups)


def test_pairs_over_a_shared_passage_are_all_found(spark):
    """80 pairs, all 160 texts with the same 140 words, so that every bucket holds many unlike texts."""
    rnd = random.Random(4)
    passage = [f"word{rnd.randrange(10**6)}" for _ in range(140)]
    texts = []
    for _ in range(80):
        own = [f"word{rnd.randrange(10**6)}" for _ in range(70)]
        at = rnd.randrange(45)
        texts += [passage + own, passage + own[:at] + [f"word{rnd.randrange(10**6)}" for _ in range(25)] + own[at + 25:]]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    df = docs(spark, [(i, " ".join(t), "s") for i, t in zip(ids, texts)])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == near_classes([list(zip(ids, texts))])


def test_texts_of_one_word(spark):
    """Repetitions of a word are near one another by length alone: chains of classes, in a fixed number of rounds."""
    sizes = [8 + i * i // 40 for i in range(200)]
    df = docs(spark, [(i, "x " * n, "s") for i, n in enumerate(sizes)])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == near_classes([[(i, ["word7"] * n) for i, n in enumerate(sizes)]])
    far = [8, 11, 14, 18, 23, 29, 37, 47, 59, 74, 93, 117, 147, 184, 230, 288]
    df = docs(spark, [(i, "x " * n, "s") for i, n in enumerate(far)])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == near_classes([[(i, ["word7"] * n) for i, n in enumerate(far)]])


def test_texts_under_one_id_and_without_words(spark):
    same = "one two three four five six seven eight nine ten"
    df = docs(spark, [(1, same, "a"), (1, "quite another text that shares nothing with it", "a"), (2, same, "a"), (None, "", "a"),
                      (None, None, "a"), (None, " ", "a"), (None, "", "a"), (2, same, "a"), (3, same + " eleven", "b")])
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in neardup.keep_one(df).collect())
    assert kept == sorted([("1", same), ("1", "quite another text that shares nothing with it"), *[("None", x) for x in ("", "", " ", "")]])
    clash = df.withColumnsRenamed({"host": "kept", "key": "_kept", "lang": "class_id"}).withColumn("node", F.lit(1))
    assert neardup.keep_one(clash).columns == clash.columns and neardup.keep_one(clash).count() == len(kept)


def test_neighbours_over_the_cuts_of_tasks(spark):
    """Sorted buckets cut over many tasks give the pairs of one task."""
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(4), rnd.randrange(3)) for i in range(400)]
    schema = "band int, value long, n int, doc long, label long, agree binary"
    whole = sorted((0, v, 100, i, i, np.array([v, 7, 9, 3, 4, w], "<u4").tobytes()) for i, v, w in rows)
    import pyarrow as pa

    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def batches(part):
        for lo in range(0, len(part), 7):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part[lo:lo + 7]), types)], names)

    def run(part, p):
        return [r for b in neardup._neighbours(batches(part), 5, 0.8, p) for r in b.to_pylist()]

    one = {(r["a"], r["b"]) for r in run(whole, 0) if r["cut"] is None}
    want = {tuple(sorted((whole[i][3], whole[j][3]))) for i in range(400) for j in range(max(0, i - 5), i) if whole[i][1] == whole[j][1]}
    assert one == want
    parts = [whole[lo:lo + 130] for lo in range(0, 400, 130)]
    found = [r for p, x in enumerate(parts) for r in run(x, p)]
    pairs = {(r["a"], r["b"]) for r in found if r["cut"] is None}
    for cut in range(len(parts) - 1):
        edge = sorted((r["place"], *[r[c] for c in names], cut) for r in found if r["cut"] == cut)
        b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*edge))[1:], [*types, pa.int32()])], [*names, "cut"])
        pairs |= {(r["a"], r["b"]) for x in neardup._neighbours([b], 5, 0.8, None) for r in x.to_pylist()}
    assert pairs == want


def test_near_duplicates_odd_rows(spark, odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == 9
    assert {r["doc_id"]: r["kept"] for r in got if r["doc_id"] in (1, 2, 3)} == {1: True, 2: True, 3: True}
    assert neardup.keep_one(odd).count() == 8  # the repeated row once
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


# --- pages

def plain_text(page):
    """Text outside tags, character by character: a quote opens a value only straight after an equals sign."""
    out, i = [], 0
    while i < len(page):
        if page[i] == "<" and i + 1 < len(page) and (page[i + 1].isalpha() and page[i + 1].isascii() or page[i + 1] == "/" and page[i + 2:i + 3].isalpha()):
            quote, after = "", False
            i += 2
            while i < len(page) and not page[i].isspace() and page[i] not in "/>":  # the name
                i += 1
            while i < len(page) and (quote or page[i] != ">"):
                if quote:
                    quote = "" if page[i] == quote else quote
                elif after and page[i] in "\"'":
                    quote, after = page[i], False
                elif not page[i].isspace():
                    after = page[i] == "="
                i += 1
            out.append("|")
        else:
            out.append(page[i])
        i += 1
    return [" ".join(x.split()) for x in "".join(out).split("|")]


def test_tags_end_outside_quotes_and_no_text_is_lost():
    text = lambda p: [b[1] for b in htmltext.blocks(p)]
    assert text("<p title=don't>Hello world</p>") == ["Hello world"]
    assert text('<article><p a=5" b>One</p><p>Two " three</p></article>') == ["One", 'Two " three']
    assert text('<p a = "x > y" b=\'>\'>In</p>2 < 3 <![CDATA[c < d]]><!-- > --> end<!x>.') == ["In", "2 < 3 c < d end."]
    assert text("before<p a=b") == ["before"] and text("a <!-- never closed <p>x") == ["a"] and text("<script>x<p>y") == []
    rnd = random.Random(5)
    for _ in range(3000):
        page = "".join(rnd.choice(["<p ", "<div", "</p>", ">", "a=", '"', "'", " ", "x y", "z=1", "=", "\n", "word", "</div>"]) for _ in range(rnd.randrange(25)))
        assert "".join(text(page)).replace(" ", "") == "".join(plain_text(page)).replace(" ", ""), page


def test_a_long_page_of_unclosed_tags_is_read_once():
    import time

    start = time.time()
    for piece in ("<a ", "<a<", "<p a='", "< ", "<!--", "</p ", "<p>", "a=", "<script>", '<p a="b" c=', "&amp"):
        htmltext.blocks(piece * (1_000_000 // len(piece)))
    assert time.time() - start < 60


# --- toxicity

def test_toxicity_learns_and_scores_every_row(spark, odd):
    rnd = random.Random(1)
    words = [f"plain{i}" for i in range(80)]
    rows = []
    for i in range(300):
        text = [rnd.choice(words) for _ in range(40)]
        if i % 3 == 0:
            text[rnd.randrange(40)] = rnd.choice(["grobnik", "schnurz"])
        rows.append((i, " ".join(text), "s"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(10, None), (None, 1)], "doc_id long, toxic int")
    df = docs(spark, rows)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, toxicity.train(df, labels)).collect()}
    assert sum((out[i] >= 0.5) == (i % 3 == 0) for i in range(200, 300)) >= 98
    assert all(0 <= x <= 1 for x in out.values())
    model = toxicity.train(df, labels)
    assert len(toxicity.score(odd, model).collect()) == 9
    none = toxicity.train(df, labels.limit(0))
    assert max(r["score"] for r in toxicity.score(odd, none).collect()) < 0.5
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_toxicity_features_are_distinct_and_cased():
    a, b = toxicity.features("Some  Text\n"), toxicity.features("some text")
    assert a.tolist() == b.tolist() == sorted(set(a.tolist())) and len(toxicity.features(None)) == len(toxicity.features("")) == 0


# --- pages

PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header>Top <a href=x>home</a></header><nav><ul><li>One<li>Two</ul></nav><!-- no --><div class=\"ad\">Buy</div>"
        "<article><h1>Head &amp; line</h1><p>First  <b>bold</b>\n part &lt;x&gt;<br>next<p>Second &eacute;.</article>"
        "<section class='comments'><p>Nice!</p></section><form><label>Mail</label></form><footer>&copy; me</footer></body></html>")


def test_blocks_and_teacher():
    cut = htmltext.blocks(PAGE)
    main = [t for p, t, _ in cut if htmltext.teach(p)]
    assert main == ["Head & line", "First bold part <x> next", "Second é."]
    assert htmltext.blocks(None) == htmltext.blocks("") == [] and [b[1] for b in htmltext.blocks("just text")] == ["just text"]
    assert htmltext.blocks("<p>a<script>x<y</p>") == htmltext.blocks("<p>a")  # never closed


def test_labeller_gradients():
    net = htmltext.Labeller(6, 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(7, 6)), np.array([3, 4]), np.array([0, 1, 1, 0, 1, 0, 0.0])
    _, grads = net.gradients(x, sizes, y)
    for k, v in net.p.items():
        i = tuple(np.array(v.shape) // 2)
        v[i] += 1e-2
        up = net.gradients(x, sizes, y)[0]
        v[i] -= 2e-2
        down = net.gradients(x, sizes, y)[0]
        v[i] += 1e-2
        assert abs((up - down) / 2e-2 - grads[k][i]) < 1e-3, k


def test_extract_learns_the_teacher(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = htmltext.train(pages, max_pages=100)
    wrong = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        cut = htmltext.blocks(r["html"])
        keep = model.logits(*htmltext.vectors([cut])) > 0
        wrong += sum(bool(k) != bool(htmltext.teach(b[0])) for k, b in zip(keep, cut))
        total += len(cut)
    assert wrong <= 0.002 * total
    df = spark.createDataFrame([(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, None, None, 1), (None, "u", "", 1)],
                               "page_id long, url string, html string, text long")
    out = [(r["page_id"], r["text"], r["n_chars"]) for r in htmltext.extract(df, model).collect()]
    assert out[0] == out[1] and out[0][2] == len(out[0][1]) and "Buy" not in out[0][1] and "Second é." in out[0][1]
    assert out[2:] == [(2, "", 0), (None, "", 0)]
    assert htmltext.extract(df.limit(0), model).count() == 0 and htmltext.train(df.limit(0)) is not None


# --- packing

def brute_best_fit(lengths, top):
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [r for r in room if r >= lengths[i]]
        rows.append(min(fit) if fit else top)
        if fit:
            room.remove(min(fit))
        if rows[-1] > lengths[i]:
            room.append(rows[-1] - lengths[i])
    return sorted(room), rows


def test_best_fit_matches_linear_search():
    rnd = random.Random(3)
    for top in (1, 2, 7, 64, 100):
        for _ in range(40):
            lengths = [rnd.randint(1, top) for _ in range(rnd.randrange(60))]
            rows = packing.best_fit(lengths, top)
            assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
            left = sorted(top - sum(lengths[i] for i in r) for r in rows if sum(lengths[i] for i in r) < top)
            assert left == brute_best_fit(lengths, top)[0]


@pytest.mark.parametrize("tokenizer", [packing.byte_tokenizer(), packing.bpe_tokenizer()], ids=["bytes", "bpe"])
def test_packed_rows_round_trip(spark, odd, tmp_path, tokenizer):
    path = packing.write_packed(odd, f"file://{tmp_path}/packed", seq_len=512, window=5000, tokenizer=tokenizer)
    packed = spark.read.parquet(path)
    for r in packed.collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == 512 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 512
        assert (ids[r["n_tokens"]:] == tokenizer.pad).all()
        resets = np.flatnonzero(np.unpackbits(np.frombuffer(r["resets"], np.uint8)))
        assert resets.tolist() == r["cu_seqlens"][:-1]
        pos = packing.positions(r["cu_seqlens"], 512)
        assert all(pos[i] == 0 for i in resets)
    parts = {}
    for r in packing.segments(packed).collect():
        parts.setdefault((r["doc_id"], r["chunk"]), []).append(r["ids"])
    want = {}
    for r in odd.collect():
        ids = packing.ended(tokenizer, r["text"])
        for k in range(0, len(ids), 512):
            want.setdefault((r["doc_id"], k // 512), []).append(ids[k:k + 512].tobytes())
    assert {k: sorted(map(bytes, v)) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(odd.limit(0)).count() == 0


# --- BPE

def test_bpe_matches_the_library(spark, odd):
    import public_tokenizers as P

    enc = bpe.encoder(bpe.rank_path(), P.PATTERN)
    got = sorted(map(tuple, bpe.encode_documents(odd).collect()), key=str)
    want = []
    for r in odd.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.decode_documents(bpe.encode_documents(odd, digests=False)).collect()
    assert sorted(bytes(r["raw"]) for r in back) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert bpe.encode_documents(odd.limit(0)).count() == 0


def test_safe_boundaries_keep_the_ids():
    import public_tokenizers as P

    enc = bpe.encoder(bpe.rank_path(), P.PATTERN)
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "B", "'s", " ", "  ", "\n", "\r\n", "\t", "9", "!", "é", " ", " ", "\x1c", "\x85", "語", "😀"]) for _ in range(80))
        for chunk in (1, 5, 17):
            assert "".join(bpe.pieces(text, chunk)) == text
            assert bpe.encode(enc, text, chunk).tolist() == enc.encode_ordinary(text)


# --- WARC

def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "long page " * 20_000
    rows = [(i, f"http://h/{i}", f"<html>page {i % 7} {'text ' * 50}</html>") for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", big), (None, "u", "alone"), (None, "u", big), (5, "http://h/5", rows[5][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.archive(df, f"file://{tmp_path}/w", archive_bytes=4000).collect()
    assert len(out) == len(rows) and all(r["intact"] for r in out)
    owner = {}
    for i, _, h in rows:
        owner[h or ""] = max(owner.get(h or "", -1), -1 if i is None else i)
    want = sorted((str(i), len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "revisit" if owner[h or ""] != (-1 if i is None else i) else "response") for i, _, h in rows)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"]) for r in out) == want
    assert all((r["refers_to"] is not None) == (r["record_type"] == "revisit") for r in out)
    small = warc.plan_records(df, min_bytes=1_000_000)
    assert small.where("revisit").count() == 0
    assert warc.archive(df.limit(0), f"file://{tmp_path}/none").count() == 0


def test_archive_layout(tmp_path):
    import struct

    import zstandard

    path = tmp_path / "a.warc.zst"
    with open(path, "wb") as f:
        w = warc.ArchiveWriter(f, sample_bytes=20_000)
        for i in range(300):
            w.add(warc.record(i, f"http://h/{i}", b"<html><body>record number %d of the archive</body></html>" % i))
        w.close()
    raw = path.read_bytes()
    magic, n = struct.unpack("<II", raw[:8])
    assert magic == warc.DICT_MAGIC
    d = zstandard.ZstdCompressionDict(raw[8:8 + n])
    first = zstandard.ZstdDecompressor(dict_data=d).decompress(raw[8 + n:])  # one frame per record
    assert first.startswith(b"WARC/1.1") and first.count(b"WARC/1.1") == 1
    with open(path, "rb") as f:
        assert [warc._id(h["warc-record-id"]) for h, _ in warc.read_records(f)] == list(range(300))


def test_written_keeps_rows(spark, odd):
    assert written(odd, "t").count() == 9


def test_near_pairs_beyond_the_window_of_a_bucket_are_linked(spark, monkeypatch):
    rnd = random.Random(5)
    words = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    shared = words(60)
    texts = [shared + words(30) for _ in range(60)]  # unlike texts of common buckets
    for i in range(0, 20, 2):  # near pairs: 12 of 90 words differ, so that they share the common passage's buckets only
        texts.append([w if k < 60 or k % 5 < 3 else f"x{i}{k}" for k, w in enumerate(texts[i])])
    monkeypatch.setattr(neardup, "WINDOW", 1)
    monkeypatch.setattr(neardup, "MIN_AGREE", 20)
    monkeypatch.setattr(neardup, "CHUNK", 8)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    sketches = {r["doc"]: {(j, v) for j, v in enumerate(r["sketch"])} for r in neardup.sketch_rows(df).collect()}
    met = [i for i in range(0, 20, 2) if sketches[i] & sketches[60 + i // 2]]
    assert len(met) > 5
    for i in met:
        assert got[60 + i // 2] == i
    assert all(got[i] == i for i in range(60))


def test_pairs_just_beyond_the_similarity_are_not_aligned(spark):
    """Copies with other words put in and near nothing but their original: they share buckets, and few pairs are left to align."""
    rnd = random.Random(8)
    vocab = [f"word{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(700)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rnd.sample(range(700), 90):
            text[at] = rnd.choice(vocab)
        rows.append((i, text))
    rows += [(60 + i, [*text[:-3], "x", "y", "z"]) for i, text in rows[:5]]
    known = neardup.sketch_rows(docs(spark, [(i, " ".join(t), "s") for i, t in rows])).cache()
    members = known.select("doc", F.posexplode("sketch").alias("band", "value")).join(known.select("doc", F.col("doc").alias("label")), "doc")
    members = neardup._contested(members.drop("label"), members.select("doc", "label").distinct())
    rest = neardup._rest_pairs(known, members, 0.8).collect()
    got = {(r["a"], r["b"]) for r in rest}
    first = {(r["a"], r["b"]) for r in rest if r["closest"]}
    sketches = {r["doc"]: set(enumerate(r["sketch"])) for r in known.collect()}
    tokens = {r["doc"]: np.frombuffer(r["tokens"], "<u4") for r in known.collect()}
    known.unpersist()
    met = {(a, b) for a in sketches for b in sketches if a < b and sketches[a] & sketches[b]}
    near = {p for p in met if neardup.similar(tokens[p[0]], tokens[p[1]])}
    assert near <= got <= met and len(near) >= 5 and len(met) > 300
    assert len(got) <= len(near) + len(met) // 20
    # the pair that every class aligns first
    assert {(i, 60 + i) for i in range(5)} <= first and {x for p in got for x in p} == {x for p in first for x in p}


def test_shared_marks_never_refuse_near_texts():
    rnd = random.Random(9)
    texts = []
    for n in (5, 40, 300, 2000):
        for vocab in (1, 3, 50, 10**6):
            base = [rnd.randrange(vocab) for _ in range(n)]
            for edits in (0, n // 20, n // 6, n // 5, n // 4, n // 2):
                text = list(base)
                for _ in range(edits):
                    at = rnd.randrange(len(text))
                    text[at:at + rnd.choice([0, 1])] = rnd.choice([[], [rnd.randrange(vocab)]])
                    text = text or [0]
                texts.append(np.array(text, "<u4"))
    of = [neardup.marks(t).tobytes() for t in texts]
    pairs = np.array([(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
                      if abs(len(texts[i]) - len(texts[j])) <= 0.2 * max(len(texts[i]), len(texts[j]))])
    longer = [max(len(texts[i]), len(texts[j])) for i, j in pairs]
    least = np.array([n - int(n * 0.2 + 1e-9) for n in longer])
    passed = neardup._spare_words(of, pairs[:, 0], pairs[:, 1], least) >= 0
    near = np.array([neardup.distance(texts[i], texts[j], n) <= n - m for (i, j), n, m in zip(pairs, longer, least)])
    assert near.sum() > 30 and (~passed).sum() > 30 and passed[near].all()
    assert [neardup.similar(texts[i], texts[j]) for i, j in pairs] == near.tolist()
    # a text without marks meets all
    missing = neardup._spare_words([b"", *of[1:]], pairs[:, 0], pairs[:, 1], np.full(len(pairs), 10**9)) >= 0
    assert missing.tolist() == [i == 0 for i, _ in pairs]
    assert len(neardup.marks(np.zeros(neardup.MARK_WORDS + 1, "<u4"))) == 0
