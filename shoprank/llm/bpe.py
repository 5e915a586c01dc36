"""Byte-level BPE encoding and decoding (operator 9).

Texts are encoded with the tiktoken library by a local rank file, one encoder
per Python worker, and decoded from raw bytes. A text longer than ``CHUNK``
code points is cut first at safe boundaries: between a character that is not
white space and a following space or line feed. No alternative of the pattern
matches across such a place (every match of non-white characters ends there
and a run of white space starts there), so the pieces' ids joined together
are the ids of the whole. A text without such a place is cut no further.

Defined results: null text = empty text = no ids; ids are little-endian
unsigned 32-bit integers; special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 1 << 16
_CUT = re.compile(r"(?<=\S)(?=[ \n])")

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def rank_path(name: str = RANKS) -> str:
    """Path of a rank file of the installed public vocabulary package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def encoder(path: str, pattern: str):
    """The tiktoken encoder of a rank file (base64 token and rank per line), once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """``text`` cut at safe boundaries into pieces of about ``chunk`` code points."""
    lo = 0
    while len(text) - lo > chunk:
        m = _CUT.search(text, lo + chunk)
        if m is None:
            break
        yield text[lo:m.start()]
        lo = m.start()
    yield text[lo:]


def encode(enc, text: str | None, chunk: int = CHUNK) -> np.ndarray:
    """Ids of a text as little-endian uint32."""
    if not text:
        return np.empty(0, "<u4")
    if len(text) <= chunk:
        return np.array(enc.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), "<u4") for p in pieces(text, chunk)])


def decode(enc, ids: np.ndarray) -> bytes:
    """Raw bytes of the ids; joined, they are the text's UTF-8 also where a token ends inside a character."""
    return enc.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     pattern: str | None = None, digests: bool = True) -> DataFrame:
    """Encode every text and decode the ids again.

    With ``digests`` the result is ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``; otherwise ``doc_id, n_tokens, ids`` (binary, uint32).
    Reads two columns, keeps repeated rows, needs no shuffle.
    """
    import public_tokenizers

    path, pattern = path or rank_path(), pattern or public_tokenizers.PATTERN
    schema = RESULT if digests else "doc_id long, n_tokens long, ids binary"

    def run(batches):
        enc = encoder(path, pattern)
        for b in small_batches(batches):
            n, first, second = [], [], []
            for text in b.column(1):
                ids = encode(enc, text.as_py())
                raw = ids.tobytes()
                n.append(len(ids))
                first.append(hashlib.sha256(raw).hexdigest() if digests else raw)
                if digests:
                    second.append(hashlib.sha256(decode(enc, ids)).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string() if digests else pa.binary())]
            names = ["doc_id", "n_tokens", "ids_sha256" if digests else "ids"]
            if digests:
                cols.append(pa.array(second, pa.string()))
                names.append("decoded_sha256")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, raw`` (binary UTF-8) from ``doc_id, ids`` of :func:`encode_documents`."""
    import public_tokenizers

    path, pattern = path or rank_path(), pattern or public_tokenizers.PATTERN

    def run(batches):
        enc = encoder(path, pattern)
        for b in small_batches(batches):
            raw = [None if x.as_py() is None else decode(enc, np.frombuffer(x.as_py(), "<u4")) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], ["doc_id", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, raw binary")
