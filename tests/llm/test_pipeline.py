"""The pipeline against a brute-force version on a small table, and its place in the entry module."""

import hashlib
import random

import corpus_pipeline
from pyspark.sql import functions as F
import __spark_entry__ as entry
from shoprank.llm import bpe, mixing, neardup, quality
from shoprank.llm.oracle import SQL
from shoprank.llm.queries import QUERIES


def make(spark, path):
    rnd = random.Random(6)
    vocab = [f"Word{i}," for i in range(300)]
    rows = []
    for i in range(120):
        lines = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(8, 30))) for _ in range(rnd.randrange(1, 9))]
        if i % 5 == 0:
            lines.insert(1, "This passage stands in many documents of the table.")
        rows.append((i, "\n".join(lines), f"src{rnd.randrange(4)}"))
    for i in range(120, 150):
        words = rows[rnd.randrange(120)][1].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), f"src{rnd.randrange(4)}"))
    rows += [(150, "too short", "src0"), (151, None, None), (152, "same again now " * 60, "src1")]
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{path}/documents.parquet")
    return rows


def brute(spark, rows):
    kept = [r for r in rows if not (quality.base_counts(r[1])[0] < 50 or 100 * quality.base_counts(r[1])[4] > 50 * quality.base_counts(r[1])[0])]
    first = {}
    for i, t, _ in kept:
        for line in t.split("\n"):
            first.setdefault(line.strip(" \t\r\x0b\x0c").lower(), i)
    clean = [(i, "\n".join(x for x in t.split("\n") if len(x.strip()) < 10 or first[x.strip().lower()] == i), s) for i, t, s in kept]
    import numpy as np

    ids = {}
    seqs = [np.array([ids.setdefault(w.lower(), len(ids)) for w in t.split()], "<u4") for _, t, _ in clean]
    label = list(range(len(clean)))
    for i in range(len(clean)):
        for j in range(i):
            if len(seqs[i]) and len(seqs[j]) and label[i] != label[j] and neardup.similar(seqs[i], seqs[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    stay = [clean[i] for i in range(len(clean)) if label[i] == i]
    df = spark.createDataFrame(stay, "doc_id long, text string, source string")
    times = {r["doc_id"]: r["times"] for r in mixing.mix(df).collect()}
    enc = bpe.encoder(bpe.rank_path(), __import__("public_tokenizers").PATTERN)
    return sorted((i, len(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in stay for _ in range(times[i]))


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = make(spark, tmp_path)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in out.collect()) == brute(spark, rows)


def test_stages_keep_the_columns(spark, tmp_path):
    make(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_stages_keep_further_and_clashing_columns(spark, tmp_path):
    """Extra columns named like the operators' own, repeated rows, nulls and a very long text."""
    make(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    long = spark.createDataFrame([(900, "".join(f"word{i} " for i in range(60_000)), "en", "src1", 1), (901, None, None, None, None)] * 2, docs.schema)
    docs = docs.unionByName(long).withColumns({c: F.lit(c) for c in ("kept", "_doc", "size", "times", "class_id", "node", "host", "_key")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert out.where("kept <> 'kept' OR _doc <> '_doc' OR size <> 'size' OR class_id <> 'class_id'").count() == 0
        assert out.where("doc_id = 900").select("kept").distinct().count() == 1


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES if k != "pipeline"}
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
