"""Token ids as binary segments with a shared zstandard dictionary.

Short documents compress badly on their own, and a large frame for many of them would have to be
unpacked whole to reach one. So every document is one zstandard frame, and all frames share a
dictionary trained on serialised id arrays.

A segment (one row of the table ``segments``, column ``payload``) is, little-endian:

======================= =====================================================================
``b"TKS1"``             magic
32 bytes                sha256 of the dictionary, all zero if none could be trained
u64                     number of documents, n
i64 * n                 doc_id (0 where null)
u8 * n                  1 where doc_id is null
u64 * (n + 1)           offset of each frame from the end of this index
u64 * n                 number of ids
frames                  ids as unsigned 32-bit integers, compressed
======================= =====================================================================

Segments are in ascending doc_id order and carry their range of ids, so that one document is found
by a pushed-down filter, an index search and the unpacking of one frame. They are rows of a Parquet
table because Spark commits those as a whole: a lost executor's half-written files never show, and
any store that Spark reaches will do. The dictionary is the table ``dictionary`` beside them.

Defined results: a null text counts as empty, which gives only the end id; null ids come first;
rows with equal ids all stay, side by side; an empty table gives an empty set of segments; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import table, worker_store
from keyweave.llm.registry import query
from keyweave.session import scratch_path

MAGIC = b"TKS1"
#: The dictionary is fitted on at most this many documents, none longer than SAMPLE_CHARS.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 65536
#: A segment ends with the document that fills it.
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 8192
CACHE_ENTRIES = 600_000

_CHUNK = re.compile("[^ \n]+")
#: Latin letters whose lower case and normal form are plain, and end marks: the usual chunk. The
#: library's normaliser and splitter leave such a chunk's two parts as they are, but for the case.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,:;!?]*)")


class WordEncoder:
    """The tokenizers library over one vocabulary, with a cache of the chunks between blanks.

    Blanks and line feeds end every token of this kind of vocabulary, so a text's ids are those of
    its chunks one after the other.
    """

    def __init__(self, vocabulary: bytes, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.end = array("I", [end_id]).tobytes()
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.model = self.tokenizer.model.tokenize
        self.alphabet = _byte_alphabet()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        chunks = [_CHUNK.findall(t or "") for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        if len(self.parts) > CACHE_ENTRIES:
            self.parts.clear()
        known, others = self.known, []
        for chunk in {c for part in chunks for c in part if c not in known}:
            plain = _PLAIN.fullmatch(chunk)
            if plain:
                known[chunk] = self._part(plain[1].lower()) + (self._part(plain[2]) if plain[2] else b"")
            else:
                others.append(chunk)
        for chunk, found in zip(others, self.tokenizer.encode_batch(others, add_special_tokens=False)):
            known[chunk] = array("I", found.ids).tobytes()
        return [b"".join(map(known.__getitem__, part)) + self.end for part in chunks]

    def _part(self, part: str) -> bytes:
        """Ids of lower-case letters or of end marks: one match of the pattern, so the merges apply as they are."""
        ids = self.parts.get(part)
        if ids is None:
            # Printable ASCII is spelled as it is.
            spelled = part if part.isascii() else part.encode().decode("latin1").translate(self.alphabet)
            ids = self.parts[part] = array("I", [t.id for t in self.model(spelled)]).tobytes()
        return ids


def _byte_alphabet() -> dict[int, int]:
    """Byte-level vocabularies spell each byte as one printable character: itself, or the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + n for n, b in enumerate(others)}


def _encoder(vocabulary: bytes, end_id: int) -> WordEncoder:
    key, store = ("words", hash(vocabulary), end_id), worker_store()
    if key not in store:
        store[key] = WordEncoder(vocabulary, end_id)
    return store[key]


def pack_segment(ids: list[int | None], counts: list[int], frames: list[bytes], dictionary: bytes) -> bytes:
    offsets = np.zeros(len(frames) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    digest = hashlib.sha256(dictionary).digest() if dictionary else bytes(32)
    return b"".join(
        [
            MAGIC,
            digest,
            np.array([len(frames)], "<u8").tobytes(),
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], "u1").tobytes(),
            offsets.tobytes(),
            np.array(counts, "<u8").tobytes(),
            *frames,
        ]
    )


class Segment:
    """Reader of one segment; a frame is only unpacked when asked for."""

    def __init__(self, payload: bytes, dictionary: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token segment")
        digest = hashlib.sha256(dictionary).digest() if dictionary else bytes(32)
        if payload[4:36] != digest:
            raise ValueError("the segment was written with another dictionary")
        (n,) = np.frombuffer(payload, "<u8", 1, 36)
        n, at = int(n), 44
        ids = np.frombuffer(payload, "<i8", n, at)
        null = np.frombuffer(payload, "u1", n, at + 8 * n)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 9 * n)
        self.counts = np.frombuffer(payload, "<u8", n, at + 17 * n + 8)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null)]
        self.frames = memoryview(payload)[at + 25 * n + 8 :]
        self._unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids_bytes(self, i: int) -> bytes:
        return self._unpack.decompress(self.frames[int(self.offsets[i]) : int(self.offsets[i + 1])])


def train_dictionary(docs: DataFrame, encode: Callable[[list[str]], list[bytes]]) -> bytes:
    """A dictionary from a bounded sample of short documents (SAMPLE_DOCS, SAMPLE_CHARS), chosen by hash of the id."""
    every = max(1, docs.count() // SAMPLE_DOCS)  # so that all tasks together send about the sample
    short = docs.select("text", F.xxhash64("doc_id").alias("order")).filter(
        F.length("text").between(1, SAMPLE_CHARS) & (F.pmod("order", F.lit(every)) == 0)
    )
    texts = [r.text for r in short.orderBy("order", "text").limit(SAMPLE_DOCS).collect()]
    samples = encode(texts)
    if sum(map(len, samples)) < 100 * len(MAGIC) or len(samples) < 10:
        return b""
    try:
        size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # samples too few or too alike
        return b""


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, end_id: int) -> None:
    """Encode every document and write the tables ``path/segments`` and ``path/dictionary``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()
    dictionary = train_dictionary(docs, WordEncoder(vocabulary, end_id).encode)
    shared = spark.sparkContext.broadcast((vocabulary, dictionary))  # sizes fixed by the vocabulary and DICTIONARY_BYTES

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, trained = shared.value
        encoder = _encoder(words, end_id)
        packer = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, write_content_size=True
        )
        shard, before = TaskContext.get().partitionId(), 0
        ids, counts, frames, size = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "start_in_shard": before,
                        "n_docs": len(ids),
                        "n_tokens": sum(counts),
                        "first_id": ids[0],
                        "last_id": ids[-1],
                        "payload": pack_segment(ids, counts, frames, trained),
                    }
                ],
                schema=SEGMENT_ARROW,
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for doc_id, data in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    frame = packer.compress(data)
                    ids.append(doc_id)
                    counts.append(len(data) // 4)
                    frames.append(frame)
                    size += len(frame)
                    if size >= SEGMENT_BYTES or len(ids) >= SEGMENT_DOCS:
                        yield flush()
                        before += sum(counts)
                        ids, counts, frames, size = [], [], [], 0
        if ids:
            yield flush()

    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest() if dictionary else "", dictionary)], DICTIONARY).write.parquet(
        f"{path}/dictionary"
    )
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(segments, SEGMENT).write.option("compression", "none").parquet(f"{path}/segments")


SEGMENT = "shard int, start_in_shard long, n_docs long, n_tokens long, first_id long, last_id long, payload binary"
SEGMENT_ARROW = pa.schema(
    [("shard", pa.int32())]
    + [(c, pa.int64()) for c in ("start_in_shard", "n_docs", "n_tokens", "first_id", "last_id")]
    + [("payload", pa.binary())]
)
DICTIONARY = "sha256 string, dictionary binary"


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    dictionary = spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary").first().dictionary
    return spark.read.schema(SEGMENT).parquet(f"{path}/segments"), bytes(dictionary)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document from the files: doc_id, start, n_tokens, ids (binary).

    ``start`` counts the ids of all documents before it. A segment knows its place in its shard; the
    shards' totals are one row per write task, so their sums are small and are broadcast.
    """
    segments, dictionary = _opened(spark, path)
    totals = segments.groupBy("shard").agg(
        F.min(F.struct(F.col("first_id").isNotNull(), "first_id")).alias("order"), F.sum("n_tokens").alias("total")
    )
    bases = totals.selectExpr(
        "shard", "sum(total) OVER (ORDER BY order, shard ROWS UNBOUNDED PRECEDING) - total AS base"
    )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["payload"], dictionary)
                starts = row["base"] + row["start_in_shard"] + np.cumsum(segment.counts) - segment.counts
                for at in range(0, len(segment.doc_ids), 512):
                    part = slice(at, at + 512)
                    ids = segment.doc_ids[part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, pa.int64()),
                            pa.array(starts[part].astype("i8")),
                            pa.array(segment.counts[part].astype("i8")),
                            pa.array([segment.ids_bytes(at + i) for i in range(len(ids))], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return segments.join(F.broadcast(bases), "shard").select("payload", "start_in_shard", "base").mapInArrow(
        unpacked, "doc_id long, start long, n_tokens long, ids binary"
    )


def read_one(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with one id, reading only the segments that can hold it."""
    segments, dictionary = _opened(spark, path)
    found = []
    for row in segments.filter((F.col("last_id") >= doc_id) & (F.coalesce("first_id", F.lit(-(2**63))) <= doc_id)).select("payload").collect():
        segment = Segment(bytes(row.payload), dictionary)
        found += [np.frombuffer(segment.ids_bytes(i), "<u4").tolist() for i, x in enumerate(segment.doc_ids) if x == doc_id]
    return found


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_documents(spark, path).selectExpr("doc_id", "start", "n_tokens", "crc32(ids) AS ids_crc32")
