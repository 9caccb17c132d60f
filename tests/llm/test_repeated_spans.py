from __future__ import annotations

import hashlib
import random
import re

import pytest

from keyweave.llm.repeated_spans import op9_repeated_spans, remove_repeated

SF = "/root/testdata/sf0.001"


def brute(rows, width):
    """(doc_id, n_words, n_removed, kept text), reading documents in order of id."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = [tuple(r) for r in op9_repeated_spans(spark, SF).orderBy("doc_id").collect()]
    assert found == [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(docs, 20)]


@pytest.mark.parametrize("width,tokens", [(2, 40), (3, 25), (5, 10**6)])
def test_random_texts_with_shared_passages(spark, width, tokens):
    rng = random.Random(width)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randrange(2, 12))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abxyz") for _ in range(rng.randrange(9))]
        rows.append((i, " ".join(words)))
    rows += [(60, None), (61, ""), (62, "a " * 50), (63, "a b " * 30), (64, "b a\n" * 30), (None, "a a a b b b")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, chunk int")
    found = remove_repeated(docs, width, tokens).collect()
    assert sorted([tuple(r) for r in found], key=lambda r: (r[0] is not None, r[0] or 0)) == brute(rows, width)


def test_empty_table_and_equal_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d")], "doc_id long, text string")
    assert sorted(r.n_removed for r in remove_repeated(docs, 3).collect()) == [0, 4]
    assert remove_repeated(docs.limit(0), 3).count() == 0
