"""Alignment of two tokenizers, against a plain version over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from keyweave.llm import token_links
from keyweave.llm.token_links import Aligner, align, aligned_groups, slices

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox.\nJumps over, the lazy dog!",
    "  two blanks  and\ttab \r\n end ",
    "<|endoftext|> and <s> are plain, <0x0A> too",
    "naïve café 漢字 ﬁne é \x00 zero",
    "a literal ▁ mark is no blank",
    "",
    None,
    " ",
    "\n\n\nlines\n",
    "x" * 5000 + " " + "y " * 3000,
]


@pytest.fixture(scope="module")
def aligner():
    with open(A, "rb") as a, open(B, "rb") as b:
        return Aligner(a.read(), b.read())


def plain(aligner, text):
    """Ids, groups and links from the contract: whole texts, ends compared pair by pair."""
    if not text:
        return [], [], [], []
    data = (" " + text).encode()
    a, b = aligner.whole(text)
    a_parts, b_parts = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if b"".join(a_parts) != data or b"".join(b_parts) != data:
        return [], [], [], []
    a_ends = [len(b"".join(a_parts[: i + 1])) for i in range(len(a))] if len(a) < 500 else _ends(a_parts)
    b_ends = [len(b"".join(b_parts[: i + 1])) for i in range(len(b))] if len(b) < 500 else _ends(b_parts)
    groups, x, y = [], 0, 0
    for i, end in enumerate(a_ends):
        if end in set(b_ends):
            j = b_ends.index(end)
            groups.append((a[x : i + 1], b[y : j + 1]))
            x, y = i + 1, j + 1
    place = {end: j for j, end in enumerate(b_ends)}
    return a, b, groups, [(a[i], b[place[end]]) for i, end in enumerate(a_ends) if end in place]


def _ends(parts):
    out, n = [], 0
    for p in parts:
        n += len(p)
        out.append(n)
    return out


def brute(aligner, rows):
    found = [(doc_id, *plain(aligner, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in found for link in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc_id,
                len(a),
                len(b),
                len(groups),
                len(links),
                sum(counts[link] == best[link[1]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_units_give_the_ids_of_whole_texts(aligner):
    rng = random.Random(5)
    parts = [*" \n\t\r▁ 　ab.,'sé0ẞ漢ﬁ́", "<|endoftext|>", "<s>", "<0x0A>", "the ", "n't", "\n\n", ";\r\n", "\nété, "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)] + TEXTS
    for text, (n_a, n_b, n_groups, joined, links) in zip(texts, aligner.summaries(texts)):
        a, b, groups, pairs = plain(aligner, text)
        assert (n_a, n_b, n_groups) == (len(a), len(b), len(groups)), text
        assert joined == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        times = Counter(x * aligner.b_size + y for x, y in pairs)
        assert {v >> token_links.TIMES_BITS: v & (1 << token_links.TIMES_BITS) - 1 for v in links.tolist()} == times


def test_slices_with_tokens_of_no_bytes():
    found = list(slices([1, 2, 3, 4], [7, 8, 9], [2, 2, 4, 6], [2, 6, 6]))
    assert found == [([1, 2], [7], [(1, 7), (2, 7)]), ([3, 4], [8, 9], [(4, 8), (4, 9)])]
    assert list(slices([], [], [], [])) == []


def test_documents_as_by_brute_force(spark, rows, aligner):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, "a null id"), (None, "a null id")]
    docs = spark.createDataFrame([(t, i, "c", 1) for i, t in data], "text string, doc_id long, row string, links int")
    assert [tuple(r) for r in sorted(align(docs.repartition(3), A, B).select(*COLUMNS).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))] == brute(aligner, data)


def test_counts_in_slices(spark, rows, aligner, monkeypatch):
    data = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    whole = rows(align(docs, A, B), *COLUMNS)
    monkeypatch.setattr(token_links, "SLICE_PAIRS", 7)
    monkeypatch.setattr(token_links, "TIMES_BITS", 3)  # 'y ' 3,000 times: one link in many shares
    assert rows(align(docs, A, B), *COLUMNS) == whole


def test_groups_spell_the_text(spark, aligner):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for doc_id, groups in aligned_groups(docs, A, B).collect():
        _, _, expected, _ = plain(aligner, TEXTS[doc_id])
        assert [(list(g.a), list(g.b)) for g in groups] == [(list(a), list(b)) for a, b in expected]
        for g in groups:
            assert b"".join(aligner.a_bytes[i] for i in g.a) == b"".join(aligner.b_bytes[i] for i in g.b)


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_query_as_by_brute_force(spark, aligner):
    folder = "/root/testdata/sf0.001"
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = token_links.op12_token_links(spark, folder).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == brute(aligner, data)
