"""Labels of subtrees, against walks in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from keyweave.operators import subtree as st
from keyweave.operators.subtree import pairs_below, subtree, subtree_labels, subtree_totals, write_labels


def forest(kind, n=60):
    rng = random.Random(n)
    if kind == "chain":
        return [(i, i - 1 if i > 1 else None) for i in range(1, n + 1)]
    if kind == "star":
        return [(1, None)] + [(i, 1) for i in range(2, n + 1)]
    rows = [(i, rng.choice([None, 0, *range(1, i)]) if i % 7 else 9999) for i in range(1, n + 1)]
    return rows + [(200, 201), (201, 200), (202, 201), (1, None)]  # a cycle, a node below it, a repeated row


def walked(rows):
    """(first, last, depth) of each node."""
    up = {}
    for node, parent in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        up[node] = parent
    children = {}
    for node, parent in up.items():
        children.setdefault(parent if parent in up else None, []).append(node)
    found = {}

    def visit(node, depth):
        found[node] = [len(found), None, depth]
        for child in sorted(children.get(node, [])):
            visit(child, depth + 1)
        found[node][1] = len(found) - 1

    for root in sorted(children.get(None, [])):
        visit(root, 0)
    return {node: tuple(found.get(node, (None, None, None))) for node in up}


def labelled(spark, rows):
    return subtree_labels(spark.createDataFrame(rows, "id bigint, boss bigint"), "id", "boss")


@pytest.mark.parametrize("kind", ["chain", "star", "mixed"])
def test_labels(spark, kind):
    rows = forest(kind)
    found = {r.id: (r.first, r.last, r.depth) for r in labelled(spark, rows).collect()}
    assert found == walked(rows)


@pytest.mark.parametrize("forced", [False, True])
def test_few_levels_need_no_walk(spark, skewed, monkeypatch, forced):
    rows = forest("star") + [(100 + i, i) for i in range(5, 50)] + [(300, 301), (301, 300)]
    monkeypatch.setattr(st, "_arcs", None)
    if forced:
        with skewed():
            found = {r.id: (r.first, r.last, r.depth) for r in labelled(spark, rows).collect()}
    else:
        found = {r.id: (r.first, r.last, r.depth) for r in labelled(spark, rows).collect()}
    assert found == walked(rows)


def test_text_keys_and_an_empty_table(spark):
    df = spark.createDataFrame([("b", "a"), ("a", None), ("c", "a"), (None, "a")], "id string, boss string")
    found = {r.id: (r.first, r.last, r.depth) for r in subtree_labels(df, "id", "boss").collect()}
    assert found == {"a": (0, 2, 0), "b": (1, 1, 1), "c": (2, 2, 1)}
    assert subtree_labels(df.limit(0), "id", "boss").count() == 0


@pytest.mark.parametrize("forced", [False, True])
def test_totals_and_pairs(spark, skewed, monkeypatch, forced):
    monkeypatch.setattr(st, "TOTALS_BLOCK", 8)
    rows = forest("mixed")
    expected = walked(rows)

    def check():
        labels = labelled(spark, rows)
        totals = subtree_totals(labels, {"sum_id": F.col("id"), "sum_odd": F.when(F.col("id") % 2 == 1, F.col("id"))})
        inside = {a: [b for b, (f, *_) in expected.items() if f is not None and lo < f <= hi] for a, (lo, hi, _) in expected.items() if lo is not None}
        found = {r.id: (r.below, r.sum_id, r.sum_odd) for r in totals.collect()}
        assert found == {a: (len(x), sum(x), sum(b for b in x if b % 2)) for a, x in inside.items()}
        pairs = sorted(map(tuple, pairs_below(labels, "id").collect()))
        assert pairs == sorted((a, b) for a, x in inside.items() for b in x)

    if forced:
        with skewed():
            check()
    else:
        check()


def test_a_subtree_is_a_range_of_the_scan(spark, tmp_path):
    rows = forest("mixed")
    write_labels(labelled(spark, rows), str(tmp_path / "labels"))
    labels = spark.read.parquet(str(tmp_path / "labels"))
    expected = walked(rows)
    for node in (1, 2, 5, 200):
        low, high, _ = expected[node]
        inside = [] if low is None else [n for n, (f, *_) in expected.items() if f is not None and low < f <= high]
        assert sorted(r.id for r in subtree(labels, "id", node).collect()) == sorted(inside)
    found = subtree(labels, "id", 1, itself=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    low, high, _ = expected[1]
    assert f"GreaterThanOrEqual(first,{low})" in plan and f"LessThanOrEqual(first,{high})" in plan
    assert subtree(labels, "id", 12345).count() == 0
