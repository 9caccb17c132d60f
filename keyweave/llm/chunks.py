"""Word sequences in chunks, and questions that chunks put to the whole corpus.

A chunk holds the words of some whole documents as numbers into its own word list. Statistics of the
corpus reach a chunk in two shuffles that carry sorted, packed integers in place of rows:

* every chunk sends each of its *distinct* keys once to the bucket of that key (``requests``);
* every bucket merges what came in and sends each chunk an answer per key, in the chunk's order.

A key in a third of all rows therefore counts once per chunk, no group is larger than a bucket or a
chunk, and both have a fixed size: their number grows with the corpus. The chunk table is written
with Spark's bucketing by chunk, so that answers come to it without a shuffle of the texts.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from array import array

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.corpus import WORD, lower_ascii, shuffle_width, worker_store
from keyweave.session import scratch_path

#: A chunk ends with the document that fills it.
CHUNK_TOKENS = 2_000_000
#: Keys a bucket should hold, over all chunks.
BUCKET_KEYS = 2_000_000

CHUNK = "chunk long, n_docs long, n_tokens long, doc_ids binary, null_ids binary, lengths binary, words binary, tokens binary"
CHUNK_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("chunk", "n_docs", "n_tokens")]
    + [(c, pa.binary()) for c in ("doc_ids", "null_ids", "lengths", "words", "tokens")]
)
BLOB = "chunk long, bucket int, kind int, blob binary"
BLOB_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])


def compress(data: bytes) -> bytes:
    store = worker_store()
    if "packer" not in store:
        store["packer"] = zstandard.ZstdCompressor(level=1)
    return store["packer"].compress(data)


def decompress(data: bytes) -> bytes:
    store = worker_store()
    if "unpacker" not in store:
        store["unpacker"] = zstandard.ZstdDecompressor()
    return store["unpacker"].decompress(data)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes of the width that the largest needs, compressed."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.view("u1").reshape(-1, 8)[:, :width].T)
    return struct.pack("<BQ", width, len(values)) + compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", blob)
    planes = np.frombuffer(decompress(blob[9:]), "u1")
    out = np.zeros((n, 8), "u1")
    if n:
        out[:, :width] = planes.reshape(width, n).T
    return out.view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype("<u8"), prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype="<u8")


def join_parts(*parts: bytes) -> bytes:
    return struct.pack("<I", len(parts)) + b"".join(struct.pack("<Q", len(p)) + p for p in parts)


def split_parts(blob: bytes) -> list[bytes]:
    (n,), at, out = struct.unpack_from("<I", blob), 4, []
    for _ in range(n):
        (size,) = struct.unpack_from("<Q", blob, at)
        out.append(blob[at + 8 : at + 8 + size])
        at += 8 + size
    return out


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Chunk:
    """One row of the chunk table, opened."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        ids, null = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["null_ids"], "u1")
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null)]
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.tokens = unpack(row["tokens"]).astype(np.int64)
        words = decompress(row["words"])
        self.words = words.split(b"\n") if words else []

    def word_hashes(self, seed: int) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)


def chunk_table(docs: DataFrame, lower: bool = False, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """The documents (doc_id, text) as stored chunks, bucketed by chunk."""
    pattern = WORD

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find = re.compile(pattern).findall
        chunk = TaskContext.get().partitionId() << 32
        numbers, tokens, ids, lengths = _Numbers(), array("i"), [], []

        def row():
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "chunk": chunk,
                        "n_docs": len(ids),
                        "n_tokens": len(tokens),
                        "doc_ids": np.array([i or 0 for i in ids], "<i8").tobytes(),
                        "null_ids": np.array([i is None for i in ids], "u1").tobytes(),
                        "lengths": np.array(lengths, "<i8").tobytes(),
                        "words": compress("\n".join(numbers).encode()),
                        "tokens": pack(np.frombuffer(tokens, "i4")) if tokens else pack(np.zeros(0)),
                    }
                ],
                schema=CHUNK_ARROW,
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                words = find(lower_ascii(text) if lower else text)
                tokens.extend(map(numbers.__getitem__, words))
                ids.append(doc_id.as_py())
                lengths.append(len(words))
                if len(tokens) >= chunk_tokens:
                    yield row()
                    chunk += 1
                    numbers, tokens, ids, lengths = _Numbers(), array("i"), [], []
        if ids:
            yield row()

    spark = docs.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    rows = docs.select("doc_id", "text").mapInArrow(build, CHUNK)
    rows.write.bucketBy(shuffle_width(spark), "chunk").option("path", scratch_path(spark, "chunks")).option(
        "compression", "none"
    ).format("parquet").saveAsTable(name)
    stored = spark.table(name)
    stored.count()  # resolves the files
    spark.sql(f"DROP TABLE {name}")  # the files stay: only the name goes
    return stored


def bucket_count(chunks: DataFrame) -> tuple[int, int]:
    """Number of buckets and of words in the corpus."""
    total = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    return max(shuffle_width(chunks.sparkSession), -(-total // BUCKET_KEYS)), total


def by_bucket(buckets: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Slices of a stable order by bucket; the caller has sorted by ``buckets``."""
    edges = np.searchsorted(buckets, np.arange(count + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(int(edges[b]), int(edges[b + 1]))


def blobs(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, BLOB_ARROW.types)], schema=BLOB_ARROW)
