from __future__ import annotations

import random

import pytest

from keyweave.llm.corpus import remainder_of
from keyweave.llm.toxicity import INSULT, TARGET, Matcher, fit, op2_toxicity, score

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def matcher():
    return Matcher({"scum": 2.0, "lowei*": 3.0})


def weight(matcher, text):
    return sum(w for w, _, _ in matcher.clauses(text)[0])


def test_clauses_weigh_more_than_words(matcher):
    plain = weight(matcher, "the scum")
    assert weight(matcher, "you are scum") > plain
    assert weight(matcher, "scum is what you are") > plain
    assert weight(matcher, "you are not scum") < plain
    assert weight(matcher, "she said scum") < plain
    assert weight(matcher, "you. scum") == plain
    assert weight(matcher, "Loweischaft!") == 3.0
    assert weight(matcher, "kill the time") == 0 < weight(matcher, "kill you all")
    assert matcher.clauses(None) == ([], 0)


def test_composition_equals_running_one_after_the_other():
    from keyweave.llm import toxicity as t

    parts, whole = [t.negation(), t.report(), t.threat(), t.target()], t.grammar()
    rng = random.Random(4)
    for _ in range(300):
        states, state = [p.start for p in parts], whole.start
        for symbol in [rng.randrange(7) for _ in range(12)]:
            out, factor, bonus = symbol, 1.0, 0.0
            for i, p in enumerate(parts):
                states[i], out, f, x = p.step(states[i], out)
                factor, bonus = factor * f, bonus + x
            state, o, f, x = whole.step(state, symbol)
            assert (o, f, x) == pytest.approx((out, factor, bonus))
    assert whole.step(whole.start, TARGET)[1] == TARGET and whole.step(whole.start, INSULT)[2] == 1.0


def test_held_out_documents(spark):
    found = {r.doc_id: r for r in op2_toxicity(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    out = [r for r in labels.filter("lang = 'en'").collect() if found[r.doc_id].held_out]
    toxic = [found[r.doc_id].predicted for r in out if r.toxic]
    clean = [found[r.doc_id].predicted for r in out if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.02
    assert all(r.held_out == (remainder_of(i, 5) == 0) and 0 <= r.score <= 1 for i, r in found.items())


def test_learned_beginnings_and_odd_rows(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(200):
        words = ["".join(rng.choice("abcdeu") for _ in range(6)) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[5] = "zorq" + words[5]
        rows.append((i, " ".join(words), toxic))
        labels.append((i, None if i == 7 else int(toxic)))
    rows += [(300, None, True), (301, "", True), (None, "zorqu " * 5000, True), (302, "zorqbanana is here", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(docs, marks)
    assert "zorq*" in model.learned
    found = {r.doc_id: r for r in score(docs, model).collect()}
    assert len(found) == len(rows)
    assert found[302].predicted == 1 and found[300].score == found[301].score < 0.5
    assert sum(found[i].predicted == int(i % 4 == 0) for i in range(200)) > 195
    nothing = fit(docs, marks.limit(0))
    assert score(docs, nothing).count() == len(rows) and score(docs.limit(0), nothing).count() == 0
