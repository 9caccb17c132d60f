"""Alignment of two tokenizers over the same texts.

Both tokenizers spell the same bytes, so a byte offset where a token of each ends cuts both id lists.
Per text, a dictionary from cumulative end to index is built for either list; the intersection of their
keys, sorted, slices the two lists into groups, and each slice gives links: pairs of one token of
either side whose byte ranges end together.

Offsets between two solid characters and around a single blank or line feed between them are cut by
both tokenizers whatever stands around: the first one's pattern never takes a blank behind a letter,
and no piece of the second has a blank behind something else. So a text is taken apart there, and a
unit's ids, groups and links are kept by its string. A text whose units do not spell it goes through
both tokenizers as a whole.

A link's count is taken over the corpus. The documents' links are stored once, counted, and meet the
counts in broadcast slices of at most SLICE_PAIRS pairs; the number of pairs is bounded by the product
of the vocabularies, and its number of slices is measured before.

Defined results: a null or empty text, and one that either tokenizer does not spell exactly, has no
tokens (zeros, empty groups); rows with equal ids are kept and answered each; an empty table gives
no rows; other columns are not read. A document is one row, so a very long text is held by one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyweave.llm.corpus import table, worker_store
from keyweave.llm.registry import query
from keyweave.session import scratch_path

#: Pairs of one broadcast slice (about 50 bytes each as a hash table).
SLICE_PAIRS = 2_000_000
#: Units a worker keeps; a full cache is emptied.
CACHE_UNITS = 500_000
CACHE_UNIT_CHARS = 64
#: A stored link holds its pair above these bits and how often it occurs below them.
TIMES_BITS = 20

_UNIT = re.compile("[ \n]?[^\\s▁]+")
_CUT = re.compile("(?<=[^\\s▁])(?=[ \n][^\\s▁])")
#: The usual unit: plain letters and end marks, with the blank or line feed before them.
_PLAIN = re.compile("(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,:;!?]*)")
_BYTE_PIECE = re.compile("<0x([0-9A-Fa-f]{2})>")


def byte_level_bytes(token: str, of: dict[str, int]) -> bytes:
    """Bytes of an entry of a byte-level vocabulary; characters outside the alphabet stand for themselves."""
    return b"".join(bytes([of[c]]) if c in of else c.encode() for c in token)


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentence piece: U+2581 is a blank, <0xHH> one byte."""
    found = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself, or the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def slices(a_ids: list[int], b_ids: list[int], a_ends: list[int], b_ends: list[int]) -> Iterator[tuple[list, list, list]]:
    """Groups of both id lists between common ends, each with its links (pairs of ids that end together).

    Tokens of no bytes end with the token before them: they belong to its group and its links.
    """
    a_at = {end: i + 1 for i, end in enumerate(a_ends)}
    b_at = {end: i + 1 for i, end in enumerate(b_ends)}
    a, b = 0, 0
    for end in sorted(a_at.keys() & b_at.keys()):
        a_stop, b_stop = a_at[end], b_at[end]
        a_last, b_last = a_stop - 1, b_stop - 1
        while a_last > a and a_ends[a_last - 1] == end:
            a_last -= 1
        while b_last > b and b_ends[b_last - 1] == end:
            b_last -= 1
        links = [(x, y) for x in a_ids[a_last:a_stop] for y in b_ids[b_last:b_stop]]
        yield a_ids[a:a_stop], b_ids[b:b_stop], links
        a, b = a_stop, b_stop


class Aligner:
    """Two tokenizers: a byte-level one (tokenizers library) and one of pieces (sentencepiece)."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(first.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        of = byte_alphabet()
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = byte_level_bytes(token, of)
        self.b_size = self.second.get_piece_size()
        self.b_bytes = [piece_bytes(self.second.id_to_piece(i)) for i in range(self.b_size)]
        self.a_lengths, self.b_lengths = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.a_text, self.b_text = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(self.b_size)]
        self.all_have_bytes = all(self.a_lengths) and all(self.b_lengths)
        self.alphabet = {b: ord(c) for c, b in of.items()}
        self.merge = self.first.model.tokenize
        self.parts: dict[str, list[int]] = {}
        self.known: dict[str, tuple | None] = {}

    def whole(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of blank + text by either tokenizer."""
        return self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)

    def groups(self, a_ids: list[int], b_ids: list[int], data: bytes) -> list[tuple[list, list, list]] | None:
        """Groups of two id lists that must spell ``data``; None if one does not."""
        if not self.spelled(a_ids, b_ids, data):
            return None
        return list(slices(a_ids, b_ids, *self.ends(a_ids, b_ids)))

    def spelled(self, a_ids: list[int], b_ids: list[int], data: bytes) -> bool:
        a, b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        return b"".join(map(a, a_ids)) == data and b"".join(map(b, b_ids)) == data

    def ends(self, a_ids: list[int], b_ids: list[int]) -> tuple[list[int], list[int]]:
        a, b = self.a_lengths.__getitem__, self.b_lengths.__getitem__
        return list(accumulate(map(a, a_ids))), list(accumulate(map(b, b_ids)))

    def align_whole(self, text: str | None) -> list[tuple[list, list, list]]:
        if not text:
            return []
        return self.groups(*self.whole(text), (" " + text).encode()) or []

    def units(self, text: str) -> list[str]:
        """Parts of blank + text that both tokenizers treat on their own."""
        spaced = " " + text
        found = _UNIT.findall(spaced)
        return found if sum(map(len, found)) == len(spaced) else _CUT.split(spaced)

    def learn(self, units: set[str]) -> None:
        """Align units that are not known yet; None is kept for those that are not spelled."""
        new = [u for u in units if u not in self.known]
        if not new:
            return
        # The second tokenizer puts a blank before every text: take the unit's own away, or drop that blank's id.
        others = [u for u in new if _PLAIN.fullmatch(u) is None]
        a = dict(zip(others, self.first.encode_batch(others, add_special_tokens=False)))
        b = self.second.encode([u[1:] if u[0] == " " else u for u in new], num_threads=1)
        for unit, b_ids in zip(new, b):
            a_ids = a[unit].ids if unit in a else self.plain_ids(unit)
            if unit[0] != " ":
                b_ids = b_ids[1:] if b_ids and self.b_bytes[b_ids[0]] == b" " else []
            self.known[unit] = self.packed_ids(a_ids, b_ids) if self.spelled(a_ids, b_ids, unit.encode()) else None

    def plain_ids(self, unit: str) -> list[int]:
        """The first tokenizer's ids of letters and end marks: the pattern makes one match of either (and of a line feed)."""
        feed, word, marks = _PLAIN.fullmatch(unit).groups()
        return [i for part in (feed, word, marks) if part for i in self.part_ids(part)]

    def part_ids(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > CACHE_UNITS:
                self.parts.clear()
            spelled = part.encode().decode("latin1").translate(self.alphabet)
            ids = self.parts[part] = [t.id for t in self.merge(spelled)]
        return ids

    def packed_ids(self, a_ids: list[int], b_ids: list[int]) -> tuple[int, str, bytes]:
        """``packed`` of the ids' groups; where every token has bytes, in one pass over the ends."""
        a_ends, b_ends = self.ends(a_ids, b_ids)
        if not self.all_have_bytes:
            return self.packed(list(slices(a_ids, b_ids, a_ends, b_ends)))
        a_text, b_text, size = self.a_text, self.b_text, self.b_size
        b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
        a = b = 0
        parts, pairs = [], []
        for a_stop, end in enumerate(a_ends, 1):
            b_stop = b_at.get(end)
            if b_stop is None:
                continue
            x, y = a_ids[a_stop - 1], b_ids[b_stop - 1]
            left, right = a_text[x], b_text[y]
            if a_stop - a > 1:
                left = ",".join([a_text[i] for i in a_ids[a:a_stop]])
            if b_stop - b > 1:
                right = ",".join([b_text[i] for i in b_ids[b:b_stop]])
            parts.append(left + "|" + right)
            pairs.append(x * size + y)
            a, b = a_stop, b_stop
        return _numbers(len(a_ids), len(b_ids), len(parts)), ";".join(parts), array("q", pairs).tobytes()

    def packed(self, groups: list[tuple[list, list, list]]) -> tuple[int, str, bytes]:
        """Numbers of a and b tokens and of groups, the groups as text, and the links as pair numbers."""
        text = ";".join([f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b, _ in groups])
        pairs = array("q", [x * self.b_size + y for _, _, links in groups for x, y in links])
        return _numbers(sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups)), text, pairs.tobytes()

    def summaries(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Per text: n_a, n_b, n_groups, the groups as text, links (pair and times in one number)."""
        split = [self.units(t) if t else [] for t in texts]
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
        distinct = set().union(*split)
        self.learn(distinct)
        for text, units in zip(texts, split):
            records = list(map(self.known.__getitem__, units))
            if None in records:  # not spelled in parts: both tokenizers over the whole text decide
                records = [self.packed(self.align_whole(text))]
            numbers = sum([r[0] for r in records])
            joined = ";".join([r[1] for r in records])
            pairs, times = np.unique(np.frombuffer(b"".join([r[2] for r in records]), np.int64), return_counts=True)
            mask = (1 << 42) - 1
            yield numbers & mask, numbers >> 42 & mask, numbers >> 84, joined, _links(pairs, times)
        for unit in distinct:
            if len(unit) > CACHE_UNIT_CHARS:
                del self.known[unit]


def _numbers(n_a: int, n_b: int, n_groups: int) -> int:
    """Three counts in one integer, so that a text's sums are one sum."""
    return n_a | n_b << 42 | n_groups << 84


def _links(pairs: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Pair and times in one number each; more than the bits hold becomes several."""
    most = (1 << TIMES_BITS) - 1
    n = (times + most - 1) // most
    times = np.minimum(np.repeat(times, n), most) if (n <= 1).all() else np.concatenate([_shares(int(t), most) for t in times])
    return np.repeat(pairs, n) << TIMES_BITS | times


def _shares(times: int, most: int) -> list[int]:
    return [most] * (times // most) + [times % most] * (times % most > 0)


def _aligner(first: bytes, second: bytes) -> Aligner:
    key, store = ("links", hash(first), hash(second)), worker_store()
    if key not in store:
        store[key] = Aligner(first, second)
    return store[key]


def _shared(spark: SparkSession, *paths: str):
    """The vocabulary files as one broadcast; their size does not depend on the corpus."""
    found = []
    for path in paths:
        with open(path, "rb") as f:
            found.append(f.read())
    return spark.sparkContext.broadcast(tuple(found))


def aligned_groups(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """Every document's groups in order: doc_id, groups (array of a, b: arrays of ids)."""
    files = _shared(docs.sparkSession, first_path, second_path)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files.value)
        for batch in batches:
            for row in range(batch.num_rows):
                groups = aligner.align_whole(batch.column(1)[row].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, 1),
                        pa.array([[{"a": a, "b": b} for a, b, _ in groups]], pa.list_(pa.struct([("a", _IDS), ("b", _IDS)]))),
                    ],
                    ["doc_id", "groups"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        grouped, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>"
    )


_IDS = pa.list_(pa.int32())
_ENCODED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>"


def encoded(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """One stored row per document: its numbers, the digest of its groups and its distinct links with times.

    ``row`` tells rows with equal ids apart; it is stored with the row, so a repeated task cannot change it.
    """
    spark = docs.sparkSession
    files = _shared(spark, first_path, second_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, row = _aligner(*files.value), TaskContext.get().partitionId() << 36
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = list(aligner.summaries(part.column(1).to_pylist()))
                offsets = np.cumsum([0] + [len(x[4]) for x in found])
                flat = np.concatenate([x[4] for x in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + part.num_rows)),
                        part.column(0),
                        *[pa.array([x[i] for x in found], pa.int64()) for i in range(3)],
                        pa.array([hashlib.sha256(x[3].encode()).hexdigest() if x[2] else "" for x in found]),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )
                row += part.num_rows

    path = scratch_path(spark, "links")
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _ENCODED).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_ENCODED).parquet(path)


def link_counts(found: DataFrame, b_size: int) -> DataFrame:
    """Per pair of ids that is linked anywhere: pair, count, and whether no other pair of its b id has more."""
    links = found.select(F.explode("links").alias("link"))
    counts = links.groupBy(F.shiftright("link", TIMES_BITS).alias("pair")).agg(
        F.sum(F.col("link").bitwiseAND((1 << TIMES_BITS) - 1)).alias("count")
    )
    # A window holds the pairs of one b id: as many as the first vocabulary has entries at most.
    of_b = Window.partitionBy(F.col("pair") % b_size)
    path = scratch_path(found.sparkSession, "link_counts")
    counts.withColumn("best", F.col("count") == F.max("count").over(of_b)).write.parquet(path)
    return found.sparkSession.read.schema("pair long, count long, best boolean").parquet(path)


def link_strength(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Per stored row: n_links, n_best, count_sum. The counts are broadcast in slices of bounded size."""
    n = max(1, -(-counts.count() // SLICE_PAIRS))
    links = found.select("row", F.explode("links").alias("link")).select(
        "row",
        F.shiftright("link", TIMES_BITS).alias("pair"),
        F.col("link").bitwiseAND((1 << TIMES_BITS) - 1).alias("times"),
    )
    parts = []
    for k in range(n):
        in_slice = F.pmod(F.xxhash64("pair"), F.lit(n)) == k if n > 1 else F.lit(True)
        met = links.filter(in_slice).join(F.broadcast(counts.filter(in_slice)), "pair")
        parts.append(
            met.groupBy("row").agg(
                F.sum("times").alias("n_links"),
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                F.sum(F.col("times") * F.col("count")).alias("count_sum"),
            )
        )
    if n == 1:
        return parts[0]
    sums = [F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return reduce(DataFrame.unionByName, parts).groupBy("row").agg(*sums)


def align(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    found = encoded(docs, first_path, second_path)
    size = sentencepiece.SentencePieceProcessor(model_file=second_path).get_piece_size()
    strength = link_strength(found, link_counts(found, size))
    whole = found.drop("links").join(strength, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return whole.select("doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256")


@query("op12_token_links")
def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
