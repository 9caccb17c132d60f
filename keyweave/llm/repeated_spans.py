"""Substring dedup by De Bruijn compaction.

The graph: an edge is a window of ``width`` words, a node the ``width - 1`` words that two following
windows share. Only edges that occur more than once matter.

1. Chunks ask which of their windows occur elsewhere or again (a short key; a false hit costs work,
   never a word).
2. Chunks ask which nodes between repeated edges branch, begin or end anywhere. All others lie
   inside a nonbranching path, so a document that enters such a path runs through it to its end.
   A document's run of repeated edges, cut at the former nodes, is a list of whole paths.
3. A path is known by a 128-bit hash of its words. Chunks send the source coordinates (document,
   start) of their first occurrence of each path; Spark finds the first of all, and every other
   occurrence is removed. An edge lies in one path at a fixed place, so this removes just the words
   covered by a window that also starts earlier.

Windows are judged on the input, not on what is left of it.

Defined results: null and empty texts have no words; a null id counts as smaller than any id; rows
with equal ids count as different documents, in the order of the chunk table; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyweave.llm.chunks import (
    BLOB,
    BLOB_ARROW,
    Chunk,
    blobs,
    bucket_count,
    by_bucket,
    chunk_table,
    join_parts,
    pack,
    pack_sorted,
    split_parts,
    unpack,
    unpack_sorted,
)
from keyweave.llm.corpus import mix64, stored, table
from keyweave.llm.registry import query

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
#: Bits of a key beyond those that number the corpus's windows: one in 2**12 keys has a false hit.
SPARE_BITS = 12
REPEATED, BREAKS = 1, 2

PATHS = "chunk long, hi long, lo long, doc_id long, start long, place long"
ANSWERS = f"{BLOB}, hi long, lo long"


class _Windows:
    """Windows of a chunk: where they start, their hashes, and which are repeated and cut."""

    def __init__(self, chunk: Chunk, width: int):
        self.chunk, self.width = chunk, width
        n = len(chunk.tokens)
        self.hash = np.zeros(0, np.uint64)
        self.node = np.zeros(0, np.uint64)
        doc_end = np.repeat(chunk.ends, chunk.lengths)
        self.valid = np.arange(n) + width <= doc_end  # a window starts here
        self.is_node = np.arange(n) + width - 1 <= doc_end
        if n:
            words = mix64(chunk.word_hashes(0))[chunk.tokens]
            self.node = self._sums(words, width - 1)
            self.hash = mix64(self._sums(words, width))
            self.node = mix64(self.node ^ np.uint64(0xA5A5A5A5))

    def _sums(self, words: np.ndarray, width: int) -> np.ndarray:
        """Polynomial hash of ``width`` words from every place, by doubling; past the end, of what is there."""
        out, have, double, reach = np.zeros(len(words), np.uint64), 0, words, 1
        with np.errstate(over="ignore"):
            while width:
                if width & 1:
                    out = out + self._power(have) * self._moved(double, have)
                    have += reach
                width >>= 1
                double = double + self._power(reach) * self._moved(double, reach)
                reach *= 2
        return out

    @staticmethod
    def _power(n: int) -> np.uint64:
        return np.uint64(pow(_BASE, n, 2**64))

    @staticmethod
    def _moved(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        if by < len(values):
            out[: len(values) - by] = values[by:]
        return out

    def edge_keys(self, bits: int):
        """Distinct keys of all windows in bucket order, how often each occurs, and each window's place among them."""
        keys, inverse, counts = np.unique(
            self.hash[self.valid] >> np.uint64(64 - bits), return_inverse=True, return_counts=True
        )
        return keys, inverse, counts

    def set_repeated(self, bits: int, buckets: int, answers: dict[int, bytes]) -> None:
        keys, inverse, _ = self.edge_keys(bits)
        self.repeated = np.zeros(len(self.valid), bool)
        self.repeated[self.valid] = _in_key_order(keys, buckets, answers)[inverse]

    def node_entries(self, bits: int):
        """For each distinct node at a repeated edge: key, tag of its two edges, and whether it is a cut here already."""
        n = len(self.repeated)
        before = np.zeros(n, bool)
        before[1:] = self.repeated[:-1]  # a valid window at i - 1 ends inside the document that holds node i
        at = np.flatnonzero((self.repeated | before) & self.is_node)
        edge_in = np.where(before[at], self.hash[at - 1], np.uint64(0))
        edge_out = np.where(self.repeated[at], self.hash[at], np.uint64(0))
        cut = ~(before[at] & self.repeated[at])
        with np.errstate(over="ignore"):
            tags = mix64(edge_in * np.uint64(3) + mix64(edge_out)) >> np.uint64(24)
        keys, first, inverse = np.unique(self.node[at] >> np.uint64(64 - bits), return_index=True, return_inverse=True)
        cuts = np.zeros(len(keys), bool)
        np.logical_or.at(cuts, inverse, cut | (tags != tags[first][inverse]))
        return at, keys, inverse, np.where(cuts, np.uint64(0), tags[first]), cuts

    def set_paths(self, bits: int, buckets: int, answers: dict[int, bytes]) -> None:
        """Runs of repeated windows cut at the cutting nodes: first window, number of windows, document, 128-bit hash."""
        at, keys, inverse, _, _ = self.node_entries(bits)
        cut = np.zeros(len(self.repeated) + 1, bool)
        cut[at] = _in_key_order(keys, buckets, answers)[inverse]
        where = np.flatnonzero(self.repeated)
        opens = np.ones(len(where), bool)
        opens[1:] = (np.diff(where) != 1) | cut[where[1:]]
        heads = np.flatnonzero(opens)
        self.first = where[heads]
        self.count = np.diff(np.append(heads, len(where)))
        self.doc = np.searchsorted(self.chunk.ends, self.first, side="right")
        words = mix64(self.chunk.word_hashes(1))[self.chunk.tokens] if len(where) else np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.append(np.uint64(1), np.full(len(words), _BASE, np.uint64)))
            back = np.cumprod(np.append(np.uint64(1), np.full(len(words), pow(_BASE, -1, 2**64), np.uint64)))
            sums = np.append(np.uint64(0), np.cumsum(words * powers[: len(words)], dtype=np.uint64))
            span = (sums[self.first + self.count + self.width - 1] - sums[self.first]) * back[self.first]
            self.hi = mix64(span).view(np.int64)
            self.lo = (self.hash[self.first] + self.count.astype(np.uint64)).view(np.int64) if len(where) else self.hi

    def first_of_each(self):
        """Place of the first occurrence of each path in this chunk, by (document, start)."""
        chunk = self.chunk
        ids = np.array([-(2**63) if i is None else i for i in chunk.doc_ids], np.int64)
        order = np.lexsort((self.first, ids[self.doc], self.lo, self.hi))
        hi, lo = self.hi[order], self.lo[order]
        new = np.ones(len(order), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        return order[new]


def _by_key(keys: np.ndarray, buckets: int):
    """Order of the keys by bucket, each bucket's keys ascending, and the slices."""
    of = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    return order, by_bucket(of[order], buckets)


def _in_key_order(keys: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """Answer bits of all buckets, brought into the order of the keys."""
    out = np.zeros(len(keys), bool)
    order, slices = _by_key(keys, buckets)
    for b, part in slices:
        out[order[part]] = np.unpackbits(np.frombuffer(answers[b], "u1"), count=part.stop - part.start).astype(bool)
    return out


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: x for b, k, x in zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["blob"].to_pylist()) if k == kind}


def _chunk(table: pa.Table) -> Chunk:
    return Chunk(table.to_pylist()[0])


def remove_repeated(docs: DataFrame, width: int = 20, chunk_tokens: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (kept_text, joined by single blanks) of every document."""
    if width < 2:
        raise ValueError("a window has at least two words")
    chunks = chunk_table(docs, chunk_tokens=chunk_tokens)
    buckets, total = bucket_count(chunks)
    bits = min(64, max(1, total).bit_length() + SPARE_BITS)

    def ask_edges(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                keys, _, counts = _Windows(chunk, width).edge_keys(bits)
                order, slices = _by_key(keys, buckets)
                rows = [
                    (chunk.chunk, b, REPEATED, join_parts(pack_sorted(keys[order[p]] // np.uint64(buckets)), np.packbits(counts[order[p]] > 1).tobytes()))
                    for b, p in slices
                ]
                yield from blobs(rows).to_batches()

    def answer_edges(requests: pa.Table) -> pa.Table:
        asked = [split_parts(b) for b in requests["blob"].to_pylist()]
        keys = [unpack_sorted(a[0]) for a in asked]
        again = [np.unpackbits(np.frombuffer(a[1], "u1"), count=len(k)).astype(bool) for a, k in zip(asked, keys)]
        _, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        hit = np.split((counts > 1)[inverse] | np.concatenate(again), np.cumsum([len(k) for k in keys])[:-1])
        bucket = requests["bucket"][0].as_py()
        return blobs([(c, bucket, REPEATED, np.packbits(h).tobytes()) for c, h in zip(requests["chunk"].to_pylist(), hit)])

    repeated = stored(chunks.mapInArrow(ask_edges, BLOB).groupBy("bucket").applyInArrow(answer_edges, BLOB), "repeated")

    def ask_nodes(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _chunk(left)
        windows = _Windows(chunk, width)
        windows.set_repeated(bits, buckets, _answers(right, REPEATED))
        _, keys, _, tags, cuts = windows.node_entries(bits)
        order, slices = _by_key(keys, buckets)
        return blobs(
            [
                (
                    chunk.chunk,
                    b,
                    BREAKS,
                    join_parts(
                        pack_sorted(keys[order[p]] // np.uint64(buckets)),
                        pack(tags[order[p]]),
                        np.packbits(cuts[order[p]]).tobytes(),
                    ),
                )
                for b, p in slices
            ]
        )

    def answer_nodes(requests: pa.Table) -> pa.Table:
        asked = [split_parts(b) for b in requests["blob"].to_pylist()]
        keys = [unpack_sorted(a[0]) for a in asked]
        sizes = [len(k) for k in keys]
        tags = np.concatenate([unpack(a[1]) for a in asked])
        cuts = np.concatenate([np.unpackbits(np.frombuffer(a[2], "u1"), count=n).astype(bool) for a, n in zip(asked, sizes)])
        _, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        cut = np.zeros(len(first), bool)
        np.logical_or.at(cut, inverse, cuts | (tags != tags[first][inverse]))
        parts = np.split(cut[inverse], np.cumsum(sizes)[:-1])
        bucket = requests["bucket"][0].as_py()
        return blobs([(c, bucket, BREAKS, np.packbits(h).tobytes()) for c, h in zip(requests["chunk"].to_pylist(), parts)])

    asked = chunks.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(ask_nodes, BLOB)
    breaks = stored(asked.groupBy("bucket").applyInArrow(answer_nodes, BLOB), "breaks")
    known = repeated.unionByName(breaks)

    def opened(left: pa.Table, right: pa.Table) -> _Windows:
        windows = _Windows(_chunk(left), width)
        windows.set_repeated(bits, buckets, _answers(right, REPEATED))
        windows.set_paths(bits, buckets, _answers(right, BREAKS))
        return windows

    def sources(left: pa.Table, right: pa.Table) -> pa.Table:
        windows = opened(left, right)
        chunk, at = windows.chunk, windows.first_of_each()
        return pa.table(
            {
                "chunk": pa.array([chunk.chunk] * len(at), pa.int64()),
                "hi": windows.hi[at],
                "lo": windows.lo[at],
                "doc_id": pa.array([chunk.doc_ids[d] for d in windows.doc[at]], pa.int64()),
                "start": windows.first[at] - chunk.starts[windows.doc[at]],
                "place": windows.first[at],
            }
        )

    paths = chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(sources, PATHS)
    order = Window.partitionBy("hi", "lo").orderBy(F.col("doc_id").asc_nulls_first(), "start", "chunk", "place")
    later = stored(paths.withColumn("nth", F.row_number().over(order)).filter("nth > 1").select("chunk", "hi", "lo"), "later")

    def cleaned(left: pa.Table, right: pa.Table) -> pa.Table:
        windows = opened(left, right)
        chunk = windows.chunk
        seen = {(h, x) for h, x, k in zip(right["hi"].to_pylist(), right["lo"].to_pylist(), right["kind"].to_pylist()) if k is None}
        gone = np.ones(len(windows.first), bool)
        for at in windows.first_of_each():
            gone[at] = (int(windows.hi[at]), int(windows.lo[at])) in seen
        edges = np.zeros(len(chunk.tokens) + 1, np.int64)
        np.add.at(edges, windows.first[gone], 1)
        np.add.at(edges, (windows.first + windows.count + width - 1)[gone], -1)
        kept = np.cumsum(edges[:-1]) == 0
        words = [w.decode() for w in chunk.words]
        texts, removed = [], []
        for s, e in zip(chunk.starts.tolist(), chunk.ends.tolist()):
            mine = chunk.tokens[s:e][kept[s:e]]
            removed.append(e - s - len(mine))
            texts.append(" ".join(map(words.__getitem__, mine.tolist())))
        return pa.table(
            {
                "doc_id": pa.array(chunk.doc_ids, pa.int64()),
                "n_words": pa.array(chunk.lengths),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(texts, pa.string()),
            }
        )

    answers = known.selectExpr("*", "cast(null as long) AS hi", "cast(null as long) AS lo").unionByName(
        later.selectExpr("chunk", "cast(null as int) AS bucket", "cast(null as int) AS kind", "cast(null as binary) AS blob", "hi", "lo")
    )
    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(cleaned, "doc_id long, n_words long, n_removed long, kept_text string")
    )


@query("op9_repeated_spans")
def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents"), width=20).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(kept_text, 256) AS kept_sha256"
    )
