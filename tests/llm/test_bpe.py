from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from keyweave.llm.bpe import Codec, PrefixTable, op7_byte_bpe, read_ranks, round_trip

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op7_byte_bpe(spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == digest(b"".join(i.to_bytes(4, "little") for i in ids))
        assert r.decoded_sha256 == digest(docs[r.doc_id].encode())


def test_odd_texts(spark, library):
    texts = [None, "", " ", "a" * 5000, "\n" * 300, "naïve 日本語 \U0001f600‍", "<|endoftext|> 12345", "it's we'll", "x"]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(None, "x", ""), (8, "x", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "x" if r.doc_id is None else texts[r.doc_id] or ""
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))
    assert round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_appends_and_edits_equal_a_fresh_table(ranks):
    codec, rng = Codec(ranks, public_tokenizers.PATTERN), random.Random(5)
    alphabet = b"abeinrst  thing\xc3\xa9"
    data = bytes(rng.choice(alphabet) for _ in range(400))
    grown = PrefixTable(codec)
    for i in range(0, len(data), 7):
        grown.append(data[i : i + 7])
    assert grown.ids() == PrefixTable(codec, data).ids()
    for _ in range(40):
        start = rng.randrange(len(grown.data))
        end = min(len(grown.data), start + rng.randrange(6))
        grown.replace(start, end, bytes(rng.choice(alphabet) for _ in range(rng.randrange(6))))
        fresh = PrefixTable(codec, bytes(grown.data))
        assert grown.last == fresh.last and grown.ids() == fresh.ids()


def test_every_prefix_is_encoded(ranks):
    codec = Codec(ranks, public_tokenizers.PATTERN)
    data = "unbelievablement".encode()
    table = PrefixTable(codec, data)
    for end in range(1, len(data) + 1):
        assert [codec.bytes_of[i] for i in PrefixTable(codec, data[:end]).ids()] == codec.merged(data[:end])
        assert codec.bytes_of[table.last[end]] == codec.merged(data[:end])[-1]


def test_pairs_equal_plain_merging(ranks):
    codec, rng = Codec(ranks, public_tokenizers.PATTERN), random.Random(9)
    tokens = sorted(codec.sound.values())
    short = [i for i in tokens if len(codec.bytes_of[i]) < 4][:400]
    for _ in range(30_000):
        a, b = (rng.choice(short), rng.choice(short)) if rng.random() < 0.7 else (rng.choice(tokens), rng.choice(tokens))
        x, y = codec.bytes_of[a], codec.bytes_of[b]
        assert codec.side_by_side(a, b) == (codec.merged(x + y) == [x, y])
