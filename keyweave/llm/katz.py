"""Katz backoff language model, learned and applied in shuffles of packed counts.

Level 1 are words, level 2 pairs of words (the end of a text is a word; it also stands before the
first one). Counts of both levels are discounted by Good and Turing's estimate up to a count of five:

    P(w)      = d(c(w)) c(w) / N                      if w was seen, else what is left over, shared
                                                      evenly by the unseen words (Chao's estimate
                                                      n1^2 / 2 n2 of how many there are)
    P(w | h)  = d(c(hw)) c(hw) / c(h)                 if the pair was seen, else alpha(h) P(w)
    alpha(h)  = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over the same w)

so that every history's probabilities sum to one exactly. Where an estimate of d leaves (0, 1), it is
replaced by (r - 1/2) / r; a history whose counts are all above five keeps one count for unseen words.

The tables: words by bucket of the word, pairs by bucket of their history. Histories with more than
one token in 1000 (at most 1000 words) are split by pair instead, and only their sums are brought
together. Word numbers follow the counts within a bucket, so packed pairs of frequent words are short.

Defined results: a null text counts as empty and has the end as its one token; a null id is hashed as
empty text; with no training text every probability is 1; rows with equal ids count and are scored
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.chunks import (
    BLOB,
    Chunk,
    blobs,
    bucket_count,
    by_bucket,
    chunk_table,
    compress,
    decompress,
    join_parts,
    pack,
    pack_sorted,
    split_parts,
    unpack,
    unpack_sorted,
)
from keyweave.llm.corpus import mix64, remainder_of, stored, table
from keyweave.llm.registry import query

#: Counts up to this one are discounted.
DISCOUNTED = 5
#: A history with more than one in HOT of all tokens is split.
HOT = 1000
WORDS, STATS, PAIRS = 1, 2, 3

PAIR_TABLE = (
    "bucket int, pairs binary, chunks array<long>, places array<binary>, "
    + ", ".join(f"n{r} long" for r in range(1, DISCOUNTED + 2))
    + ", hot array<struct<h: long, total: long, "
    + ", ".join(f"k{r}: long" for r in range(1, DISCOUNTED + 1))
    + ", low: double>>"
)


def good_turing(n: list[int]) -> np.ndarray:
    """Discounts d(0..DISCOUNTED) from the numbers of types seen once, twice, ... DISCOUNTED + 1 times."""
    d = np.ones(DISCOUNTED + 1)
    top = (DISCOUNTED + 1) * n[DISCOUNTED] / n[0] if n[0] else 1.0
    for r in range(1, DISCOUNTED + 1):
        value = -1.0
        if n[r - 1] and top < 1:
            value = ((r + 1) * n[r] / n[r - 1] / r - top) / (1 - top)
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


@dataclass(frozen=True)
class Unigrams:
    """The lowest level: N tokens, V words, discounts and what unseen words share."""

    tokens: int
    words: int
    d: np.ndarray
    total: float
    unseen: float

    @staticmethod
    def fit(tokens: int, words: int, n: list[int]) -> "Unigrams":
        d = good_turing(n)
        left = sum(n[r - 1] * r * (1 - d[r]) for r in range(1, DISCOUNTED + 1))
        total = float(tokens) if left > 0 else tokens + 1.0
        types = max(1.0, np.ceil(n[0] * n[0] / (2 * n[1]) if n[1] else n[0] * (n[0] - 1) / 2))
        return Unigrams(tokens, words, d, total, (left or 1.0) / total / types)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.d) / self.total, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, d[np.minimum(counts, DISCOUNTED)], 1.0)


def _history(total, kept, low):
    """What a history divides by, and its backoff weight; ``kept`` is the discounted sum, ``low`` P(w) of the seen."""
    divisor = np.where(total - kept > 1e-9 * np.maximum(total, 1), total, total + 1.0)
    alpha = np.where(total > 0, (1 - kept / divisor) / (1 - low), 1.0)
    return divisor, alpha


class _Corpus:
    """A chunk with the end of text as a word and the words' training counts."""

    def __init__(self, chunk: Chunk, modulus: int, held_out: int):
        self.chunk = chunk
        self.words = [*chunk.words, b""]  # no word is empty
        self.held = np.array([remainder_of(i, modulus) == held_out for i in chunk.doc_ids], bool)
        lengths = chunk.lengths + 1
        self.lengths, self.ends = lengths, np.cumsum(lengths)
        self.tokens = np.full(int(lengths.sum()), len(chunk.words), np.int64)
        inside = np.ones(len(self.tokens), bool)
        inside[self.ends - 1] = False
        self.tokens[inside] = chunk.tokens
        self.training = np.repeat(~self.held, lengths)

    def word_order(self, buckets: int):
        hashes = np.append(self.chunk.word_hashes(2), np.uint64(0))
        of = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.array(sorted(range(len(of)), key=lambda i: (of[i], self.words[i])), np.int64)
        return order, by_bucket(of[order], buckets)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.training], minlength=len(self.words))

    def set_words(self, buckets: int, answers: dict[int, bytes]) -> None:
        self.numbers, self.counts = np.zeros(len(self.words), np.uint64), np.zeros(len(self.words), np.int64)
        order, slices = self.word_order(buckets)
        for b, part in slices:
            numbers, counts = split_parts(answers[b])
            self.numbers[order[part]] = unpack(numbers)
            self.counts[order[part]] = unpack(counts).astype(np.int64)

    def pairs(self, buckets: int, hot: np.ndarray):
        """Distinct pairs in bucket order: history, word, training count, the word's count; each token's place among them."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.ends - self.lengths] = len(self.words) - 1
        keys = (self.numbers[before] << np.uint64(32)) | self.numbers[self.tokens]
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        seen = np.bincount(inverse[self.training], minlength=len(keys))
        history = keys >> np.uint64(32)
        dealt = np.where(np.isin(history, hot), keys, history)
        of = (mix64(dealt) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        return keys, seen, self.counts[self.tokens[first]], inverse, order, by_bucket(of[order], buckets)

    def history_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training count of each pair's history: a word is a history as often as it occurs."""
        order = np.argsort(self.numbers)
        place = np.searchsorted(self.numbers, keys >> np.uint64(32), sorter=order)
        return self.counts[order[place]]


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: x for b, k, x in zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["blob"].to_pylist()) if k == kind}


def _sums(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def score_documents(
    docs: DataFrame, modulus: int = 7, held_out: int = 2, chunk_tokens: int = 2_000_000
) -> DataFrame:
    """Learn from the documents whose crc32(doc_id as text) mod ``modulus`` is not ``held_out``; score all."""
    chunks = chunk_table(docs, lower=True, chunk_tokens=chunk_tokens)
    buckets, words_in_all = bucket_count(chunks)
    hot_from = max(DISCOUNTED + 1, words_in_all // HOT)

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                corpus = _Corpus(Chunk(row), modulus, held_out)
                counts = corpus.word_counts()
                order, slices = corpus.word_order(buckets)
                yield from blobs(
                    [
                        (
                            corpus.chunk.chunk,
                            b,
                            WORDS,
                            join_parts(compress(b"\n".join(corpus.words[i] for i in order[p])), pack(counts[order[p]])),
                        )
                        for b, p in slices
                    ]
                ).to_batches()

    def answer_words(requests: pa.Table) -> pa.Table:
        bucket = requests["bucket"][0].as_py()
        asked = [split_parts(b) for b in requests["blob"].to_pylist()]
        lists = [decompress(a[0]).split(b"\n") for a in asked]
        totals: dict[bytes, int] = {}
        for words, a in zip(lists, asked):
            for word, count in zip(words, unpack(a[1]).tolist()):
                totals[word] = totals.get(word, 0) + count
        ranked = sorted(totals, key=lambda w: (-totals[w], w))
        number = {w: rank * buckets + bucket for rank, w in enumerate(ranked)}
        if ranked and len(ranked) * buckets >= 2**32:
            raise OverflowError("word numbers need more than 32 bits")
        counts = np.array(list(totals.values()), np.int64)
        seen = np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
        hot = [number[w] for w in ranked if totals[w] >= hot_from]
        rows = [(-1, bucket, STATS, join_parts(pack(np.array([(counts > 0).sum(), counts.sum(), *seen[1 : DISCOUNTED + 2]])), pack(np.array(hot))))]
        for chunk, words in zip(requests["chunk"].to_pylist(), lists):
            rows.append(
                (chunk, bucket, WORDS, join_parts(pack(np.array([number[w] for w in words])), pack(np.array([totals[w] for w in words]))))
            )
        return blobs(rows)

    answered = stored(chunks.mapInArrow(ask_words, BLOB).groupBy("bucket").applyInArrow(answer_words, BLOB), "words")

    def opened_stats(batches):
        for batch in batches:
            stats = [split_parts(b) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"n": [unpack(s[0]).astype(np.int64).tolist() for s in stats], "hot": [unpack(s[1]).astype(np.int64).tolist() for s in stats]}
            )

    stats = answered.filter(F.col("kind") == STATS).select("blob").mapInArrow(opened_stats, "n array<long>, hot array<long>")
    sums = stats.agg(*[F.sum(F.col("n")[i]) for i in range(DISCOUNTED + 3)], F.flatten(F.collect_list("hot"))).first()
    words, tokens, *seen = [int(x or 0) for x in sums[:-1]]
    unigrams = Unigrams.fit(tokens, words, seen)
    hot = np.array(sorted(sums[-1] or []), np.uint64)  # HOT words at most
    to_chunks = answered.filter(F.col("kind") == WORDS)

    def ask_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        corpus = _Corpus(Chunk(left.to_pylist()[0]), modulus, held_out)
        corpus.set_words(buckets, _answers(right, WORDS))
        keys, seen, counts, _, order, slices = corpus.pairs(buckets, hot)
        low = np.uint64(0xFFFFFFFF)
        rows = []
        for b, part in slices:
            at = order[part]
            rows.append(
                (
                    corpus.chunk.chunk,
                    b,
                    PAIRS,
                    join_parts(pack_sorted(keys[at] >> np.uint64(32)), pack(keys[at] & low), pack(seen[at]), pack(counts[at])),
                )
            )
        return blobs(rows)

    def pair_table(requests: pa.Table) -> pa.Table:
        asked = [split_parts(b) for b in requests["blob"].to_pylist()]
        keys = [(unpack_sorted(a[0]) << np.uint64(32)) | unpack(a[1]) for a in asked]
        pairs, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        seen = np.zeros(len(pairs), np.int64)
        np.add.at(seen, inverse, np.concatenate([unpack(a[2]) for a in asked]).astype(np.int64))
        counts = np.concatenate([unpack(a[3]) for a in asked])[first].astype(np.int64)
        history = pairs >> np.uint64(32)
        times = np.bincount(np.minimum(seen, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
        sums = []
        for h in hot[np.isin(hot, history)]:
            mine = slice(*np.searchsorted(history, [h, h + np.uint64(1)]))
            c, lower = seen[mine], unigrams.probability(counts[mine])
            small = np.bincount(np.minimum(c, DISCOUNTED + 1), minlength=DISCOUNTED + 2)
            sums.append(
                {"h": int(h), "total": int(c.sum()), "low": float(lower[c > 0].sum())}
                | {f"k{r}": int(small[r]) for r in range(1, DISCOUNTED + 1)}
            )
        places = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
        return pa.Table.from_pylist(
            [
                {
                    "bucket": requests["bucket"][0].as_py(),
                    "pairs": join_parts(pack_sorted(history), pack(pairs & np.uint64(0xFFFFFFFF)), pack(seen), pack(counts)),
                    "chunks": requests["chunk"].to_pylist(),
                    "places": [pack_sorted(p) for p in places],
                    "hot": sums,
                }
                | {f"n{r}": int(times[r]) for r in range(1, DISCOUNTED + 2)}
            ],
            schema=PAIR_ARROW,
        )

    asked = chunks.groupBy("chunk").cogroup(to_chunks.groupBy("chunk")).applyInArrow(ask_pairs, BLOB)
    pairs = stored(asked.groupBy("bucket").applyInArrow(pair_table, PAIR_TABLE), "pairs")
    times = pairs.agg(*[F.sum(f"n{r}") for r in range(1, DISCOUNTED + 2)]).first()
    d = good_turing([int(x or 0) for x in times])
    split = pairs.select(F.explode("hot").alias("x")).groupBy("x.h").agg(
        *[F.sum(f"x.{c}").alias(c) for c in ("total", *(f"k{r}" for r in range(1, DISCOUNTED + 1)), "low")]
    )
    whole = {}
    for r in split.collect():  # HOT rows at most
        kept = r["total"] - sum(r[f"k{i}"] * i * (1 - d[i]) for i in range(1, DISCOUNTED + 1))
        divisor, alpha = _history(r["total"], kept, r["low"])
        whole[r["h"]] = (bool(divisor > r["total"]), float(alpha))

    def counted(batches):
        for batch in batches:
            for row in batch.to_pylist():
                history, _, seen, counts = split_parts(row["pairs"])
                history, seen, counts = unpack_sorted(history), unpack(seen).astype(np.int64), unpack(counts).astype(np.int64)
                starts = np.flatnonzero(np.append(True, history[1:] != history[:-1]))
                total = _sums(starts, seen)
                divisor, alpha = _history(
                    total, _sums(starts, _discounted(seen, d)), _sums(starts, np.where(seen > 0, unigrams.probability(counts), 0.0))
                )
                more = divisor > total
                for i in np.flatnonzero(np.isin(history[starts], hot)):
                    more[i], alpha[i] = whole[int(history[starts[i]])]
                of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(history))))
                rows = []
                for chunk, places in zip(row["chunks"], row["places"]):
                    at = unpack_sorted(places).astype(np.int64)
                    backing_off = np.unique(of[at[seen[at] == 0]])
                    rows.append(
                        (chunk, row["bucket"], PAIRS, join_parts(pack(seen[at] * 2 + more[of[at]]), alpha[backing_off].astype("<f8").tobytes()))
                    )
                yield from blobs(rows).to_batches()

    def katz(seen, divisor, history, alphas, counts) -> np.ndarray:
        """P(word | history): the pair's own share if it was seen, else the level below, weighted."""
        out = _discounted(seen, d) / np.maximum(divisor, 1)
        unseen = seen == 0
        _, of = np.unique(history[unseen], return_inverse=True)
        out[unseen] = alphas[of] * unigrams.probability(counts[unseen])
        return out

    logs = pairs.select("bucket", "pairs", "chunks", "places").mapInArrow(counted, BLOB)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        corpus = _Corpus(Chunk(left.to_pylist()[0]), modulus, held_out)
        corpus.set_words(buckets, _answers(right, WORDS))
        keys, _, counts, inverse, order, slices = corpus.pairs(buckets, hot)
        answers, values = _answers(right, PAIRS), np.zeros(len(keys))
        totals = corpus.history_counts(keys)
        for b, part in slices:
            at = order[part]
            found, alphas = split_parts(answers[b])
            found, alphas = unpack(found).astype(np.int64), np.frombuffer(alphas, "<f8")
            values[at] = katz(found >> 1, totals[at] + (found & 1), keys[at] >> np.uint64(32), alphas, counts[at])
        values = np.log10(values)
        starts, counts = corpus.ends - corpus.lengths, corpus.counts[corpus.tokens]
        return pa.table(
            {
                "doc_id": pa.array(corpus.chunk.doc_ids, pa.int64()),
                "held_out": corpus.held,
                "n_tokens": corpus.lengths,
                "n_known": _sums(starts, (counts > 0).astype(np.int64)),
                "train_tokens": np.full(len(starts), unigrams.tokens),
                "base_score": _sums(starts, unigrams.base(counts)),
                "score": _sums(starts, values[inverse]),
            }
        )

    return (
        chunks.groupBy("chunk")
        .cogroup(to_chunks.unionByName(logs).groupBy("chunk"))
        .applyInArrow(
            scored,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


PAIR_ARROW = pa.schema(
    [("bucket", pa.int32()), ("pairs", pa.binary()), ("chunks", pa.list_(pa.int64())), ("places", pa.list_(pa.binary()))]
    + [(f"n{r}", pa.int64()) for r in range(1, DISCOUNTED + 2)]
    + [
        (
            "hot",
            pa.list_(
                pa.struct(
                    [("h", pa.int64()), ("total", pa.int64())]
                    + [(f"k{r}", pa.int64()) for r in range(1, DISCOUNTED + 1)]
                    + [("low", pa.float64())]
                )
            ),
        )
    ]
)


@query("op1_katz")
def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
