"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, convrepair, htmltext, linededup, mih, mixing, neardup, packing, prefixbpe, quality, runs, toxicity, warc
from .common import table


def op1_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by 50, exact."""
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), mih.sign_code(F.col("embedding")).alias("code"))
    return mih.top_k(codes, codes.where(F.col("id") % 50 == 0))


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, its host's shrunk failure rate (6 places) and the verdict."""
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.withColumn("host_rate", F.round("host_rate", 6))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("times")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before, lines dropped and the digest of what is kept, per document."""
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("_doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def held_out(doc_id) -> F.Column:
    """Whether a row is kept out of training: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels.where(~held_out(F.col("doc_id"))))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.train(pages))


def op8_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed row as written: its segments, their documents, and the digest of its line of ids."""
    packed = spark.read.parquet(packing.write_packed(table(spark, sf_dir, "documents")))
    return packed.select("part", "win", "row", "n_tokens", F.size("doc_ids").cast("long").alias("n_segments"), "cu_seqlens",
                         "doc_ids", "chunks", F.sha2("ids", 256).alias("ids_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives."""
    return warc.archive(table(spark, sf_dir, "pages")).drop("intact")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every conversation, after planted damage."""
    return convrepair.report(convrepair.damaged(table(spark, sf_dir, "conversations")))


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids under the vocabulary with word ends, and of the text they decode to."""
    return prefixbpe.encode_documents(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document (every tenth with a loop) and the digest of what stays without their repetitions."""
    return runs.with_digests(runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=runs.looped))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py`` over ``documents``."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_hamming_top_k, op2_host_quality, op3_mix_sources, op4_line_dedup, op5_near_duplicates, op6_toxicity,
                            op7_html_text, op8_packed_ids, op9_bpe, op10_warc, op11_conversation_repair, op12_prefix_bpe, op13_periodic_runs, pipeline)}
