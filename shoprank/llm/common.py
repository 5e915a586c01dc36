"""Shared helpers: written intermediates in the session's shared folder, column access, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path as remove
from ..session import shared_path

#: Fixed value: the ASCII white space of the word definition (space, TAB, LF, VT, FF, CR).
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Fixed value: a word, in the regular expressions of Spark and of DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also after an error, what ``written`` leaves within; results are written after it."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for p in paths:
            remove(spark, p)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The lineage ends there, a lost executor costs no more than its own tasks,
    and the optimiser knows the size of what it reads.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if (paths := _scratch.get()) is not None:
        paths.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words (maximal runs without ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(it, rows: int = 256, max_bytes: int = 16 << 20):
    """Slices of Arrow batches that hold at most ``rows`` rows and about ``max_bytes``, but one row at least."""
    for b in it:
        per = max(1, b.nbytes // max(1, b.num_rows))
        step = max(1, min(rows, max_bytes // per))
        for lo in range(0, b.num_rows, step):
            yield b.slice(lo, step)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
