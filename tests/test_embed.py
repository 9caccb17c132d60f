import pytest
from pyspark.sql import functions as F

from keyweave.operators.embed import embed, flatten_children


def run(spark, children, page_size=10_000):
    parents = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id bigint, name string")
    df = spark.createDataFrame(children, "parent bigint, line bigint, price double")
    fields = {"line": F.col("line"), "price": F.col("price"), "twice": F.col("price") * 2}
    found = embed(parents, "id", df, "parent", fields, "lines", "n", page="page", page_size=page_size)
    assert set(found.columns) == {"id", "name", "lines", "n", "page"}
    return {(r["id"], r["page"]): ([tuple(line) for line in r["lines"]], r["n"]) for r in found.collect()}


CHILDREN = (
    [(1, 2, 1.0), (1, 1, 3.0), (1, 1, 2.0)]
    + [(2, i % 7, float(i % 3)) for i in range(50)]
    + [(3, 5, 1.0)] * 20
    + [(99, 1, 1.0), (None, 1, 1.0)]
)


def want(parent, page_size):
    lines = sorted((line, price, price * 2) for p, line, price in CHILDREN if p == parent)
    pages = [lines[i : i + page_size] for i in range(0, len(lines), page_size)] or [[]]
    return {(parent, i): (page, len(lines)) for i, page in enumerate(pages)}


@pytest.mark.parametrize("page_size", [10_000, 20, 7, 1])
@pytest.mark.parametrize("forced", [False, True])
def test_lists_and_pages(spark, skewed, page_size, forced):
    expected = {k: v for p in range(6) for k, v in want(p, page_size).items()}
    if forced:
        with skewed():
            assert run(spark, CHILDREN, page_size) == expected
    else:
        assert run(spark, CHILDREN, page_size) == expected


def test_places_run_on_over_pages(spark):
    parents = spark.range(1)
    children = spark.range(5).select(F.lit(0).alias("parent"), F.col("id").alias("line"))
    lists = embed(parents, "id", children, "parent", {"line": F.col("line")}, "lines", "n", page="page", page_size=2)
    found = flatten_children(lists, "lines", ["id"], page="page", page_size=2).collect()
    assert sorted((r["ordinal"], r["line"]) for r in found) == [(i, i) for i in range(5)]


def test_children_are_shuffled_once(spark):
    parents = spark.range(10)
    children = spark.range(100).select((F.col("id") % 10).alias("parent"), F.col("id").alias("line"))
    plan = embed(parents, "id", children, "parent", {"line": F.col("line")}, "lines", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
