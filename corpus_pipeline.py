"""Corpus pipeline: documents to token ids in five stages.

Quality rules, line dedup, near-dedup, mixing to target weights, and byte-level
BPE. Each stage takes ``(spark, docs, sf_dir)`` and works on all its
predecessor kept; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``, further
columns and such whose names the operators use themselves included.

Defined results: rows without text, with an empty or too short one fall to the
quality rules; very long texts go through whole; a null id is an id of its own
to the quality rules, and no id to near-dedup; equal texts are one class, of
which one row stays, repeated rows included; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank.llm import bpe, linededup, mixing, neardup, quality
from shoprank.llm.common import written

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict reject."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; ``n_chars`` follows the text."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    out = linededup.dedup_lines(docs)
    return out.select(*[new.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document in the mix, one row per copy."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix),
    ("byte-level BPE", encode),
]

#: Near-dedup and BPE have no SQL form; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
