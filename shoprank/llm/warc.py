"""WARC archives in dictionary-compressed Zstandard (operator 10).

Every page becomes a WARC/1.1 record. Of pages with equal payloads of at
least ``min_bytes`` bytes the one with the largest id is a ``response``
record and the others are ``revisit`` records that refer to it; smaller
payloads are all responses. Each archive starts with a skippable frame (magic
0x184D2A5D) that holds a Zstandard dictionary built from the archive's first
records, and each record is a frame of its own, compressed with it, so any
record can be read by its offset.

The pages' digests are aggregated on the map side (a payload that a third of
the pages share is one row per task); only digests that occur more than once
are joined back. Tasks write archives of at most ``archive_bytes`` of records
through Arrow's file systems to a shared folder: under a name of the attempt
first, then moved, so a task that runs again replaces its own files.

Defined results: a null page is the empty payload; a null id orders before
all others and is written as such; rows that repeat the largest id with the
same payload are all responses; the digest is SHA-1 in base 32 without a
prefix; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, small_batches, written

# Fixed values of the formats.
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_BYTES = 0
ARCHIVE_BYTES = 128 << 20
DICT_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    x = urn.strip("<>").rsplit(":", 1)[-1]
    return None if x == "null" else int(x)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False,
           digest: str | None = None, date: str = DATE) -> bytes:
    """One WARC record, uncompressed; a revisit keeps the HTTP head and leaves the payload out."""
    digest = digest or base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if revisit else head + payload
    uri = "".join(url.split()) if url else "urn:unknown"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES):
    """A dictionary from records, or None where there are too few to build one."""
    import zstandard

    if len(samples) < 8 or sum(map(len, samples)) < 4 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Records into one file object: dictionary frame first, then a frame per record."""

    def __init__(self, out, sample_bytes: int = SAMPLE_BYTES, level: int = 3):
        self.out, self.sample_bytes, self.level = out, sample_bytes, level
        self.waiting: list[bytes] = []
        self.size = self.records = 0
        self.compress = None

    def add(self, rec: bytes) -> None:
        self.size += len(rec)
        self.records += 1
        if self.compress is not None:
            self.out.write(self.compress(rec))
            return
        self.waiting.append(rec)
        if self.size >= self.sample_bytes:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        d = build_dictionary(self.waiting)
        if d is not None:
            raw = d.as_bytes()
            self.out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
            self.compress = zstandard.ZstdCompressor(level=self.level, dict_data=d).compress
        else:
            self.compress = zstandard.ZstdCompressor(level=self.level).compress
        for rec in self.waiting:
            self.out.write(self.compress(rec))
        self.waiting = []

    def close(self) -> None:
        if self.compress is None:
            self._begin()


def read_records(f):
    """``(headers, block)`` of every record of an archive (a binary file object), one at a time."""
    import zstandard

    head = f.read(8)
    d, lead = None, head
    if len(head) == 8:
        magic, n = struct.unpack("<II", head)
        if magic == DICT_MAGIC:
            d, lead = zstandard.ZstdCompressionDict(f.read(n)), b""
    ctx = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    src = f if not lead else _Lead(lead, f)
    stream = io.BufferedReader(ctx.stream_reader(src, read_across_frames=True), 1 << 16)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode().partition(":")
            headers[k.strip().lower()] = v.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


class _Lead:
    """A file object with some bytes put back in front."""

    def __init__(self, lead: bytes, f):
        self.lead, self.f = lead, f

    def read(self, n: int = -1) -> bytes:
        if self.lead:
            out, self.lead = self.lead, b""
            return out
        return self.f.read(n)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to``: which page is a response and which a revisit."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    again = p.where(F.length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(again.select(F.col("digest").alias("_digest"), "owner"), "payload-copies")
    j = p.join(again, p["digest"] == again["_digest"], "left")
    revisit: Column = F.col("_digest").isNotNull() & F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return j.select("page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("owner")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records as ``.warc.zst`` archives into ``folder``; returns the written manifest ``path, records, bytes``.

    ``folder`` is a URI that Arrow's file systems open on every executor.
    """
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        number, done = 0, []
        writer = out = temp = None

        def close():
            nonlocal writer, out, number
            writer.close()
            out.close()
            final = f"{base}/part-{task.partitionId():06d}-{number:04d}.warc.zst"
            store.move(temp, final)
            done.append((final, writer.records, store.get_file_info(final).size))
            writer, number = None, number + 1

        for b in small_batches(batches):
            for page_id, url, payload, digest, revisit, refers in zip(*(b.column(i) for i in range(6))):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    temp = f"{base}/.attempt-{task.taskAttemptId()}-{number:04d}"
                    out = store.open_output_stream(temp, compression=None)
                    writer = ArchiveWriter(out)
                d = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                writer.add(record(page_id.as_py(), url.as_py(), payload.as_py(), refers.as_py(), revisit.as_py(), d))
                if writer.size >= archive_bytes:
                    close()
        if writer is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return written(records.select("page_id", "url", "payload", "digest", "revisit", "refers_to").mapInArrow(run, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per archived record: ``page_id, payload_bytes, payload_digest, record_type, refers_to, intact``.

    An archive is one task's work and is streamed; ``intact`` tells whether a
    response's payload has the digest and length of its headers.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])

    def row(h: dict, block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        n = int(head.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
        digest = h["warc-payload-digest"].partition(":")[2]
        same = h["warc-type"] == "revisit" or (
            len(payload) == n and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)
        refers = h.get("warc-refers-to")
        return _id(h["warc-record-id"]), n, digest, h["warc-type"], None if refers is None else _id(refers), same

    def run(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                with store.open_input_stream(path, compression=None, buffer_size=1 << 20) as f:
                    rows = []
                    for h, block in read_records(f):
                        rows.append(row(h, block))
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), schema)], schema=schema)

    n = manifest.count()  # a number per archive, so that each can be a task of its own
    return manifest.select("path").repartition(max(1, n), "path").mapInArrow(run, RECORD)


def new_folder(spark: SparkSession) -> str:
    """A new archive folder (URI) in the shared folder."""
    path = shared_path(spark, "warc")
    return path if ":" in path.split("/", 1)[0] else f"file://{path}"


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES,
            **columns) -> DataFrame:
    """Write all pages and read the archives back."""
    folder = folder or new_folder(pages.sparkSession)
    manifest = write_archives(plan_records(pages, min_bytes=min_bytes, **columns), folder, archive_bytes)
    return read_archives(manifest, folder)
