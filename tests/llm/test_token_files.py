from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keyweave.llm.token_files import op10_token_files, read_documents, read_one, write_token_files

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = [tuple(r) for r in op10_token_files(spark, SF).orderBy("doc_id").collect()]
    assert found == expected(library, docs)


def test_odd_texts_and_single_documents(spark, library, tmp_path):
    texts = [None, "", " \n ", "A" * 3000, "É́ à la", "x<|endoftext|>y don't", "tab\tand nbsp sep \x1c z", "İΣΑΣ ς", "a  b\r\n", "ÀÉß Ünï, œuvre! ﬁn ʼn ÷× x...! ?a Straße;: 'S it's, don't.", "e\u0301t\u00e9, \u212b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "last first")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    write_token_files(docs, f"{tmp_path}/t", PATH, end_id=1)
    found = read_documents(spark, f"{tmp_path}/t").collect()
    got = sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in found)
    assert [(d, s, n, c) for s, d, n, c in got] == expected(library, rows)
    assert read_one(spark, f"{tmp_path}/t", 5) == [library.encode(texts[5], add_special_tokens=False).ids + [1]]
    assert read_one(spark, f"{tmp_path}/t", 99) == []
    write_token_files(docs.limit(0), f"{tmp_path}/e", PATH, end_id=1)
    assert read_documents(spark, f"{tmp_path}/e").count() == 0


def test_short_documents_use_the_dictionary(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    write_token_files(docs, f"{tmp_path}/t", PATH, end_id=1)
    stored = spark.read.parquet(f"{tmp_path}/t/dictionary").first()
    assert len(stored.sha256) == 64 and len(stored.dictionary) > 1000
    rows = docs.collect() + docs.limit(3).collect()
    write_token_files(docs.unionAll(docs.limit(3)), f"{tmp_path}/d", PATH, end_id=1)
    assert read_documents(spark, f"{tmp_path}/d").count() == len(rows)
