from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from keyweave.llm.katz import DISCOUNTED, op1_katz, score_documents

SF = "/root/testdata/sf0.001"


def discounts(counts):
    n = Counter(counts)
    top = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1
    d = {}
    for r in range(1, DISCOUNTED + 1):
        v = ((r + 1) * n[r + 1] / n[r] / r - top) / (1 - top) if n[r] and top < 1 else -1
        d[r] = v if 0 < v < 1 else (r - 0.5) / r
    return d, n


class Model:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for words in texts:
            for h, w in zip(["</s>", *words], [*words, "</s>"]):
                self.uni[w] += 1
                self.bi[h][w] += 1
        self.n = sum(self.uni.values())
        self.du, n = discounts(self.uni.values())
        self.db, _ = discounts(c for x in self.bi.values() for c in x.values())
        left = sum(n[r] * r * (1 - self.du[r]) for r in self.du)
        self.total = self.n if left > 0 else self.n + 1
        types = max(1, math.ceil(n[1] ** 2 / (2 * n[2]) if n[2] else n[1] * (n[1] - 1) / 2))
        self.unseen = (left or 1) / self.total / types
        self.types = types
        self.alpha, self.divisor = {}, {}
        for h, seen in self.bi.items():
            total = sum(seen.values())
            kept = sum(c * self.db.get(c, 1) for c in seen.values())
            self.divisor[h] = total if total - kept > 1e-9 * total else total + 1
            self.alpha[h] = (1 - kept / self.divisor[h]) / (1 - sum(self.lower(w) for w in seen))

    def lower(self, w):
        c = self.uni[w]
        return c * self.du.get(c, 1) / self.total if c else self.unseen

    def p(self, w, h):
        c = self.bi[h][w] if h in self.bi else 0
        return c * self.db.get(c, 1) / self.divisor[h] if c else self.alpha.get(h, 1.0) * self.lower(w)


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check(rows, found):
    assert len(found) == len(rows)
    model = Model([words_of(t) for i, t in rows if not held(i)])
    expected = defaultdict(list)
    for doc_id, text in rows:
        words = words_of(text)
        seq = [*words, "</s>"]
        base = sum(math.log10((model.uni[w] + 1) / (model.n + len(model.uni) + 1)) for w in seq)
        score = sum(math.log10(model.p(w, h)) for h, w in zip(["</s>", *words], seq))
        expected[doc_id].append((held(doc_id), len(seq), sum(model.uni[w] > 0 for w in seq), model.n, base, score))
    for r in found:
        assert tuple(r)[1:] == pytest.approx(expected[r.doc_id][0], rel=1e-9)
    return model


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = op1_katz(spark, SF).collect()
    model = check(rows, found)
    for h in list(model.bi)[:50]:
        assert sum(model.p(w, h) for w in model.uni) + model.alpha[h] * model.unseen * model.types == pytest.approx(1)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_small_chunks_odd_texts_and_hot_histories(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("The the a b c d e f g".split()) for _ in range(rng.randrange(30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "é " * 200), (83, "never seen " * 3), (None, "The a"), (85, "the " * 300)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    check(rows, score_documents(docs, chunk_tokens=100).collect())


def test_nothing_to_learn_from(spark):
    only_held = next(i for i in range(100) if held(i))
    docs = spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")
    row = score_documents(docs).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
    assert score_documents(docs.limit(0)).count() == 0
