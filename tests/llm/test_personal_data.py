from __future__ import annotations

import hashlib
import random
import re

from keyweave.llm.personal_data import BASE, estimate, find, op8_personal_data, train

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def ok(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PLAIN[k], text or "") if ok(k, m[0])]


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op8_personal_data(spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        expected = base(docs[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in expected)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in expected) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans.startswith(joined)
    added = [s for r in found for s in r.spans.split(",") if s.startswith("secret:")]
    assert added


def spans_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    names = ["email", "ip", "card", "phone", "secret", "local_phone", "name"]
    return {r.doc_id: [(names[s.kind], s.start, s.end) for s in r.spans] for r in find(docs).collect()}


def test_random_and_odd_texts(spark):
    rng = random.Random(2)
    pieces = ["a@b.c", "a@b", "@", ".", "x_y", "1.2.3.4", "1.2.3.256", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+", "12", " ", "-", "\U0001f600", "é", "_d@e.f", "..", "\n", "(5"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(400)]
    texts += [None, "", "a" * 60_000, "a." * 30_000, "1" * 60_000, "1 " * 30_000, "1.2." * 20_000, "x@" + "a." * 20_000 + "b", "+1" + " " * 50_000, "a@b.c " * 3000]
    found = spans_of(spark, texts)
    for i, t in enumerate(texts):
        assert [s for s in found[i] if s[0] in BASE] == base(t), t


def test_labelers_add_spans(spark):
    texts = [f"login password={'%016x' % (i * 7919 + 10**15)} now, mail a{i}@b.com" for i in range(30)]
    texts += ["sample token=placeholder", "call 212-555-0199 today", "version 000 111 2222", "Dear Dr. Anna Miller, hello"]
    found = spans_of(spark, texts)
    assert all(any(k == "secret" for k, _, _ in found[i]) for i in range(30))
    assert found[30] == [] and found[32] == []
    assert found[31] == [("local_phone", 5, 17)] and found[33] == [("name", 5, 20)]


def test_secrets_in_capitals_and_long_ones_are_whole(spark):
    value = "9233A8EC" * 2
    heads = ['TOKEN = "', "Password: ", "API_KEY=", "Access_Key = ", "token="]
    texts = [f"mail a{i}@b.com, login {head}{value} now" for i, head in enumerate(heads)] * 6
    long = "eyJhbGciOi1" * 300
    texts.append(f"mail a@b.com, login secret={long} now")
    found = spans_of(spark, texts)
    for i, text in enumerate(texts):
        inside = long if i == len(texts) - 1 else value
        start = text.index(inside)
        assert ("secret", start, start + len(inside)) in found[i], text[:60]


def test_em_and_classifier():
    patterns = {(4, (1, 0, 1, 0, 1)): 50, (4, (1, 0, 1, 0, 0)): 40, (4, (-1, -1, 0, -1, 0)): 30, (4, (0, 0, 0, 0, 0)): 5}
    belief = estimate(patterns)
    assert belief[4, (1, 0, 1, 0, 1)] > 0.9 > 0.1 > belief[4, (-1, -1, 0, -1, 0)]
    kinds, yes, no = train(patterns)
    assert kinds[0] + yes[0] + yes[2] > 0 > kinds[0] + no[0] + no[1] + no[3]
    assert train({})[1] == [1.0] * 5


def test_empty_table(spark):
    assert find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
