from __future__ import annotations

from collections import defaultdict

import pytest
import regex

from keyweave.llm import decontaminate as m
from keyweave.llm.decontaminate import find_items, op6_decontaminate

SF = "/root/testdata/sf0.01"


def prepared(text):
    for c in "\x01\x02\x03":
        text = (text or "").replace(c, "")
    plain = regex.sub(m.ALONE, "", text)
    out = regex.sub(m.NAMES, m.NAME, plain)
    out = regex.sub(m.NUMBERS, m.NUMBER, out)
    out = regex.sub(m.MARKS, "", regex.sub(m.UNITS_AFTER, m.UNIT, out)).lower()
    cut = lambda t: regex.split(r"[\x20\x09-\x0D]+", t)
    return cut(plain), cut(out)


def bare(word):
    return regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", word)


def raw_form(words):
    return [regex.sub(m.MARKS, "", w).lower() for w in words]


def occurrences(raw, tmpl, item_raw, item_tmpl, size, use):
    """Windows of the item found in a document, by diagonal, where the slots are consistent."""
    of = (lambda r, t: t) if use == m.TEMPLATE else (lambda r, t: raw_form(r))
    mine, theirs = of(item_raw, item_tmpl), of(raw, tmpl)
    asked = [k for k in range(len(mine) - size + 1) if use == m.RAW or literals(item_tmpl[k : k + size]) >= m.LITERALS]
    index = defaultdict(list)
    for k in asked:
        index[tuple(mine[k : k + size])].append(k)
    hits = defaultdict(set)
    for k in range(len(theirs) - size + 1):
        for at in index.get(tuple(theirs[k : k + size]), ()):
            hits[k - at].add(at)
    good = []
    for diagonal, ats in hits.items():
        pairs = set()
        for at in ats:
            for j in range(at, at + size):
                if use == m.TEMPLATE and set(item_tmpl[j]) & set("\x01\x02\x03"):
                    pairs.add((item_tmpl[j], bare(item_raw[j]), bare(raw[j + diagonal])))
        names = [p for p in pairs if m.NAME in p[0]]
        if len({p[:2] for p in pairs}) == len(pairs) and len({p[2] for p in names}) == len(names):
            good.append(len(ats))
    return sum(good), len(asked)


def literals(tmpl):
    return sum(not set(w) & set("\x01\x02\x03") for w in tmpl)


def brute(docs, items, window=m.WINDOW, share=m.SHARE):
    """Pairs of document and item by the rules of the module's text, each pair on its own."""
    out = set()
    cut = [(d, *prepared(t)) for d, t in docs]
    for i, text in items:
        raw, tmpl = prepared((text or "").strip(" \t\n\v\f\r"))
        ends = [n for n, w in enumerate(raw) if w]
        if not ends:
            continue
        raw, tmpl = raw[ends[0] : ends[-1] + 1], tmpl[ends[0] : ends[-1] + 1]
        size = min(window, len(raw))
        total = len(raw) - size + 1
        usable = sum(literals(tmpl[k : k + size]) >= m.LITERALS for k in range(total))
        if usable and usable >= share * total:
            uses = [m.TEMPLATE, m.RAW] if len(raw) < window else [m.TEMPLATE]
        else:
            uses = [m.RAW]
        for d, doc_raw, doc_tmpl in cut:
            if len(raw) < m.LITERALS:
                if [w for w in raw_form(doc_raw) if w] == [w for w in raw_form(raw) if w]:
                    out.add((d, i))
                continue
            for use in uses:
                matched, asked = occurrences(doc_raw, doc_tmpl, raw, tmpl, size, use)
                if matched and matched >= share * asked:
                    out.add((d, i))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = op6_decontaminate(spark, SF).collect()
    assert len(found) > 10 and all(r.coverage > 0.8 and r.same_values for r in found)
    assert {(r.doc_id, r.item_id) for r in found} == brute(docs, items)


ITEM = "When Tom buys 5 apples and gives 3 kg to Anna, how many of the 5 apples does Tom keep for himself?"


@pytest.mark.parametrize("rows", [200_000, 0])
def test_reparameterised_questions(spark, monkeypatch, rows):
    monkeypatch.setattr(m, "BROADCAST_ROWS", rows)
    texts = [
        f"Intro words. {ITEM} More.",
        "so " + ITEM.replace("5", "12").replace("Tom", "Kim").replace("Anna", "Lea").replace("kg", "pounds"),
        ITEM.replace("5", "12", 1),  # one of two equal numbers changed
        ITEM.replace("Anna", "Tom"),  # two names became one
        "When did all of this happen and why does nobody know about the apples in the garden of the house?",
        None, "", " ", " ".join(ITEM.split()[:6]), ITEM.replace(" ", "  -- ") , ITEM + " " + ITEM, "word " * 20_000,
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, ITEM), (1, "other text of a repeated id")]
    items = [(7, ITEM), (8, None), (9, "too short"), (10, ITEM)]
    found = find_items(
        spark.createDataFrame([(*d, 3) for d in docs], "doc_id long, text string, item_id int"),
        spark.createDataFrame([(*i, 4) for i in items], "item_id long, text string, doc_id int"),
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == brute(docs, items)
    assert {d for d, _ in got} == {0, 1, 10, None}
    assert {r.doc_id: r.same_values for r in found if r.item_id == 7}[1] is False
    empty = spark.createDataFrame([], "item_id long, text string")
    assert find_items(spark.createDataFrame(docs, "doc_id long, text string"), empty).count() == 0


def test_items_of_few_words_and_many_slots(spark):
    """Verbatim copies of short items and of items that are mostly numbers or names."""
    items = [
        (1, "What is the capital of France?"),
        (2, "The numbers are 12, 15, 18, 21, 24, 27 and 30. What is the sum of 12, 15, 18, 21, 24, 27 and 30?"),
        (3, "Find the mean of the data 12, 15, 18, 21, 24, 27, 30, 33, 36, 39, 42 and 45."),
        (4, "Welche Länder liegen an Rhein, Donau, Elbe, Oder, Weser, Main, Neckar, Mosel, Saar?"),
        (5, "Name it"),
        (6, " Solve for x: 3 x + 5 = 20, 4 x + 6 = 22, 5 x + 7 = 27. "),
        (7, "."),
    ]
    copies = [(10 + i, f"Some words before it. {t} And some words after it.") for i, t in items]
    docs = copies + [
        (30, "Then what is the capital of Spain?"),  # the same question with another name
        (31, "The numbers are 1, 2, 3, 4, 5, 6 and 7. What is the sum of 9, 8, 7, 6, 5, 4 and 3?"),
        (32, "name it!"),
        (33, " Name  it "),
        (34, "He could not name it at all."),
        (35, "Find the mean of the data in the table below and write it into the box."),
        (36, "It asked What is the capital of France? twice."),
        (37, "Nobody knows what the capital of a country is without a map."),
    ]
    found = find_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == brute(docs, items) and len(found) == len(got)
    assert {(10 + i, i) for i in (1, 2, 3, 4, 6)} <= got
    assert {(30, 1), (36, 1), (32, 5), (33, 5)} <= got
    assert not {d for d, _ in got} & {15, 31, 34, 35, 37}
