"""The pipeline against a version of its own: each stage's decisions by brute force."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from keyweave.llm.bpe import read_ranks
from keyweave.llm.toxicity import Matcher, fit

SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(spark):
    import math

    import numpy as np
    from test_decontaminate import brute as leaks
    from test_near_copies import brute as copies

    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in frame.collect()}
    model = fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    matcher = Matcher(model.learned)
    for d, text in list(docs.items()):
        z = float(np.dot([1, *matcher.features(text)], model.beta))
        if 1 / (1 + math.exp(-z)) >= 0.5:
            del docs[d]
    # Lines: classes by distance 1 from 20 characters on, shorter ones if they are equal; the first of each stays.
    places = [(d, i, x) for d in sorted(docs) for i, x in enumerate(docs[d].split("\n")) if x.strip(" \t\n\v\f\r")]
    parent = {x: x for _, _, x in places}
    names = sorted((x for x in parent if len(x) >= 20), key=len)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if len(b) - len(a) > 1:
                break
            half = len(a) // 2
            if (a[:half] == b[:half] or a[half + 1 :] == b[len(b) - len(a) + half + 1 :]) and edits(a, b) <= 1:
                parent[root(a)] = root(b)
    first, gone = {}, {}
    for d, i, x in places:
        if first.setdefault(root(x), (d, i)) != (d, i):
            gone.setdefault(d, set()).add(i)
    for d, some in gone.items():
        docs[d] = "\n".join(x for i, x in enumerate(docs[d].split("\n")) if i not in some)
        if not docs[d].strip():
            del docs[d]
    for d, _, _, kept in copies(sorted(docs.items()), 5, 80):
        if not kept:
            del docs[d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, _ in leaks(sorted(docs.items()), items):
        docs.pop(d, None)
    return docs


def test_pipeline_equals_brute_force(spark):
    docs = expected(spark)
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(found) == set(docs)
    for d, text in docs.items():
        ids = library.encode_ordinary(text)
        assert found[d].n_tokens == len(ids)
        assert found[d].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert found[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_input_and_columns(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = stage(spark, docs.limit(0), SF)
    assert empty.count() == 0
    if name != "byte_bpe":
        assert empty.dtypes == docs.dtypes
