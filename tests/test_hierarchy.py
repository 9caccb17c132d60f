import pytest

from keyweave.operators import hierarchy
from keyweave.operators.hierarchy import depths, layers
from keyweave.session import estimated_bytes


def run_depths(spark, pairs):
    df = spark.createDataFrame(pairs, "id bigint, boss bigint")
    return {r["id"]: (r["root"], r["depth"]) for r in depths(df, "id", "boss").collect()}


def test_depths(spark):
    found = run_depths(spark, [(1, None), (2, 1), (3, 2), (4, 0), (5, 4), (6, 77)])
    assert found == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (4, 0), 5: (4, 1), 6: (6, 0)}


def test_depth_of_a_chain(spark):
    n = 70
    found = run_depths(spark, [(i, i - 1) for i in range(1, n + 1)])
    assert found == {i: (1, i - 1) for i in range(1, n + 1)}


def test_cycles_have_no_root(spark):
    found = run_depths(spark, [(1, 2), (2, 1), (3, 1), (4, 4), (5, None)])
    assert found == {1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (5, 0)}


@pytest.mark.parametrize("forced", [False, True])
def test_star(spark, skewed, forced):
    pairs = [(1, None)] + [(i, 1) for i in range(2, 200)]

    def run():
        return run_depths(spark, pairs)

    expected = {1: (1, 0), **{i: (1, 1) for i in range(2, 200)}}
    if forced:
        with skewed():
            assert run() == expected
    else:
        assert run() == expected


def run_layers(spark, nodes, edges):
    df = spark.createDataFrame([(n,) for n in nodes], "node string")
    links = spark.createDataFrame(edges, "node string, needs string")
    return {r["node"]: r["layer"] for r in layers(df, links).collect()}


def test_layers(spark):
    edges = [("b", "a"), ("c", "b"), ("c", "a"), ("d", "d"), ("e", "unknown"), ("b", "a")]
    assert run_layers(spark, "abcde", edges) == {"a": 0, "b": 1, "c": 2, "d": 0, "e": 0}


def test_cycle_goes_to_the_last_layer(spark):
    assert run_layers(spark, "abcd", [("b", "c"), ("c", "b"), ("d", "b"), ("b", "a")]) == {"a": 0, "b": 1, "c": 1, "d": 1}


def test_no_nodes(spark):
    assert run_layers(spark, "", []) == {}


def plain_layers(nodes, edges):
    needs = {n: {b for a, b in edges if a == n and b != n and b in nodes} for n in nodes}
    found, layer = {}, 0
    while len(found) < len(nodes):
        ready = [n for n in nodes if n not in found and needs[n] <= found.keys()] or [n for n in nodes if n not in found]
        found |= dict.fromkeys(ready, layer)
        layer += 1
        if any(needs[n] - found.keys() for n in found):
            break
    return found


def test_layers_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(hierarchy, "stored", lambda df, name, real=hierarchy.stored: steps.append(name) or real(df, name))
    nodes = [f"n{i:04d}" for i in range(1000)]
    # Two chains that meet at the end, in a node that needs both.
    edges = [(nodes[i], nodes[i - 1]) for i in range(1, 1000)] + [("top", nodes[999]), ("top", "n0500")]
    found = run_layers(spark, [*nodes, "top"], edges)
    assert found == {n: i for i, n in enumerate(nodes)} | {"top": 1000}
    assert steps.count("reached") == 2  # one round frees the top, one finds nothing behind it


@pytest.mark.parametrize("forced", [False, True])
@pytest.mark.parametrize("kind", ["ladder", "random", "hub", "cycle behind"])
def test_layers_as_by_plain_rounds(spark, skewed, kind, forced):
    import random

    rng = random.Random(kind)
    nodes = [f"n{i:02d}" for i in range(40)]
    if kind == "ladder":
        edges = [(nodes[i], nodes[j]) for i in range(2, 16) for j in (i - 1, i - 2)]
    elif kind == "hub":
        edges = [(n, "n00") for n in nodes[1:]] + [("n39", n) for n in nodes[:39]]
    else:
        edges = [(nodes[i], nodes[rng.randrange(i)]) for i in range(1, 40) for _ in range(rng.randrange(4))]
    if kind == "cycle behind":
        edges += [("n03", "n20"), ("n20", "n03"), ("n21", "n21")]

    def check():
        assert run_layers(spark, nodes, edges) == plain_layers(nodes, edges)

    if forced:
        with skewed():
            check()
    else:
        check()


def test_layers_take_a_node_named_zero(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "node bigint")
    links = spark.createDataFrame([(1, 0), (2, 1)], "node bigint, needs bigint")
    assert {r["node"]: r["layer"] for r in layers(df, links).collect()} == {0: 0, 1: 1, 2: 2}


def test_rounds_do_not_multiply_the_estimated_size(spark):
    chain = spark.range(1, 65).selectExpr("id", "id - 1 AS boss")
    found = depths(chain, "id", "boss")
    assert estimated_bytes(found) < 1 << 20
    assert found.agg({"depth": "max"}).first()[0] == 63
