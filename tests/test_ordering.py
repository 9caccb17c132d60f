import pytest
from pyspark.sql import functions as F

from keyweave.operators import ordering
from keyweave.operators.ordering import PositionIndex, batches, page, resume_after, with_group_positions, with_positions


def test_positions_follow_the_order(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(100000)).alias("v"), "id")
    placed = with_positions(df, ["v", "id"]).collect()
    assert sorted(r["position"] for r in placed) == list(range(5000))
    by_position = sorted(placed, key=lambda r: r["position"])
    assert [(r["v"], r["id"]) for r in by_position] == sorted((r["v"], r["id"]) for r in placed)


def test_positions_with_one_value_everywhere(spark):
    df = spark.range(1000).select(F.lit(1).alias("v"), "id")
    assert sorted(r["position"] for r in with_positions(df, ["v"]).collect()) == list(range(1000))


def test_group_positions_with_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), "id")
    placed = with_group_positions(df, ["g"], ["id"]).collect()
    groups = {}
    for r in placed:
        groups.setdefault(r["g"], []).append((r["position"], r["id"]))
    for members in groups.values():
        members.sort()
        assert [p for p, _ in members] == list(range(len(members)))
        assert [i for _, i in members] == sorted(i for _, i in members)


def test_group_positions_with_weights_and_null_group(spark):
    df = spark.createDataFrame([(None, 1, 3), (None, 2, 2), (None, 3, 1), ("a", 1, 5)], "g string, v bigint, w bigint")
    placed = {(r["g"], r["v"]): r["position"] for r in with_group_positions(df, ["g"], ["v"], weight="w", partitions=3).collect()}
    assert placed == {(None, 1): 0, (None, 2): 3, (None, 3): 5, ("a", 1): 0}


@pytest.mark.parametrize("limit, offset", [(10, 0), (10, 25), (None, 25), (0, 25), (0, 0), (None, 0), (500, 90), (5, 1000)])
def test_page(spark, limit, offset):
    df = spark.range(100)
    end = offset + limit if limit else 100
    assert sorted(r["id"] for r in page(df, ["id"], limit, offset).collect()) == list(range(100))[offset:end]


def test_deep_page_goes_by_positions(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_ROWS_BOUND", 10)
    df = spark.range(100)
    assert sorted(r["id"] for r in page(df, [F.desc("id")], 20, 30).collect()) == list(range(50, 70))


def test_resume_after(spark):
    df = spark.range(30)
    assert resume_after(df, ["id"], 0).count() == 30
    assert sorted(r["id"] for r in resume_after(df, ["id"], 28).collect()) == [28, 29]


@pytest.mark.parametrize("size, sizes", [(25, [25, 25, 3]), (1, [1] * 53), (10, [10] * 5 + [3]), (100, [25, 25, 3])])
def test_batches(spark, size, sizes):
    df = spark.range(53)
    found = batches(df, ["id"], size).groupBy("batch").count().orderBy("batch").collect()
    assert [r["batch"] for r in found] == list(range(len(sizes)))
    assert [r["count"] for r in found] == sizes


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        batches(spark.range(3), ["id"], 0)


def _sorted_rows(rows, *columns):
    """Rows by (name, descending) columns; nulls first ascending and last descending, as Spark has them."""
    rows = sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
    for name, descending in reversed(columns):
        rows.sort(key=lambda r: (r[name] is not None, r[name] if r[name] is not None else 0), reverse=descending)
    return rows


@pytest.mark.parametrize("columns", [(("a", False),), (("a", True),), (("s", False), ("a", True)), (("a", False), ("s", True), ("id", False))])
def test_pages_of_a_position_index(spark, columns):
    df = spark.range(400).select(
        F.when(F.col("id") % 9 > 0, (F.col("id") * 7 % 40).cast("double")).alias("a"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).alias("s"),
        "id",
    )
    order = [F.desc(c) if down else F.col(c) for c, down in columns]
    index = PositionIndex(df, order, partitions=5)
    every = _sorted_rows(df.collect(), *columns)
    assert index.rows == 400 and set(index.slices.columns) == {c for c, _ in columns} | {"__slice"}
    for offset, limit in ((0, 10), (3, 1), (44, 100), (199, 7), (390, 50), (0, None), (250, None), (400, 5), (399, None)):
        found = sorted(r["id"] for r in index.page(df, offset, limit).collect())
        assert found == sorted(r["id"] for r in every[offset : None if limit is None else offset + limit]), (offset, limit)


def test_pages_of_equal_rows(spark):
    df = spark.range(100).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("v"))
    assert PositionIndex(df, ["k"]).page(df, 30, 50).count() == 50
    assert PositionIndex(df.limit(0), ["k"]).page(df.limit(0), 0, 5).count() == 0
    with pytest.raises(ValueError):
        PositionIndex(df, [F.col("v") + 1])


def test_a_deep_page_is_a_range_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_ROWS_BOUND", 10)
    spark.range(1000).select("id", F.concat(F.lit("payload"), "id").alias("payload")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = page(df, ["id"], 100, 500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(id,500),EqualTo(id,500))" in plan and "LessThan(id,600)" in plan and "Exchange" not in plan
    assert sorted(r["id"] for r in found.collect()) == list(range(500, 600))
