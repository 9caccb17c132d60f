from __future__ import annotations

import random
import re

import pytest

from keyweave.llm import near_copies as m
from keyweave.llm.near_copies import components, near_copies, op4_near_copies

SF = "/root/testdata/sf0.001"


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op4_near_copies(spark, SF).collect()) == brute(docs, 4, 80)


@pytest.mark.parametrize("list_length,block,k", [(32, 128, 64), (3, 2, 64), (3, 4, 16)])
def test_chains_groups_and_shared_passages(spark, monkeypatch, list_length, block, k):
    monkeypatch.setattr(m, "LIST", list_length)
    monkeypatch.setattr(m, "BLOCK", block)
    rng = random.Random(list_length + k)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    common, rows = text(30), []
    for n in (6, 40, 90):  # near copies around a base, some far from it
        base = text(n)
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(1 + n // 25)):
                words[rng.randrange(n)] = rng.choice(vocabulary)
            rows.append(" ".join(words))
    chain = text(60)
    for i in range(12):  # each is near the next, the ends are not near each other
        rows.append(" ".join(chain[i * 2 : i * 2 + 45]))
    rows += [" ".join(text(25) + common) for _ in range(15)]
    rows += [rows[0]] * 5 + [None, "", "one", "one", "One two", "a " * 400, "a " * 500]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, node int")
    assert sorted(tuple(r) for r in near_copies(docs, 4, 80, k).collect()) == brute(rows, 4, 80)


def test_texts_that_take_no_part_are_not_moved(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(200)] + [(None, "a b c d e"), (500, "a b c d f"), (501, "a b c d e")]
    rows += [(600 + i, "p q r s t u v w x y z " * 2 + f"end{i}") for i in range(3)]
    steps, store = {}, m.stored
    monkeypatch.setattr(m, "stored", lambda df, name: steps.setdefault(name, df) and store(df, name))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_copies(docs, 4, 80).collect()}
    assert found[601] == found[602] == 600 and found[500] == 500 and found[None] is found[501] is None
    # The texts meet a bitmap of fixed size before the join that moves them.
    assert "bitmap_construct_agg" in steps["hashes"]._jdf.queryExecution().optimizedPlan().toString()
    ids = spark.createDataFrame([(3,), (m.NULL_ID,)], "doc long")
    texts = docs.selectExpr(f"coalesce(doc_id, {m.NULL_ID}) AS doc", "text")
    assert {r.doc for r in m._possible(texts, ids).collect()} == {3, m.NULL_ID}
    assert m._possible(texts, ids.limit(0)).count() == 0


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "A b c d e"), (4, None)], "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_copies(docs).collect()}
    assert found == {(None, 1, None, True), (3, 1, None, False), (4, 0, 4, True)}
    assert near_copies(docs.limit(0)).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (70, 60), (60, 60)], "a long, b long")
    found = dict(components(edges).collect())
    assert found == {i: 0 for i in range(41)} | {50: 50, 60: 50, 70: 50}
