import pytest
from pyspark.sql import functions as F

from keyweave.operators.joins import frequent_keys, keyed_join, lookup, one_row_per_key, or_default, related_rows


@pytest.fixture
def facts(spark):
    """A third of the rows on key 7, a third without key, the rest spread."""
    return spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 500).cast("bigint").alias("k")
    )


@pytest.fixture
def dimension(spark):
    return spark.range(300).select(F.col("id").alias("key"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


def expected(facts, dimension, how):
    names = {r["key"]: r["name"] for r in dimension.collect()}
    found = []
    for r in facts.collect():
        hit = r["k"] is not None and r["k"] in names
        if how == "left" or (how == "inner" and hit):
            found.append((r["id"], r["k"], names.get(r["k"]) if r["k"] is not None else None))
        elif (how == "left_semi" and hit) or (how == "left_anti" and not hit):
            found.append((r["id"], r["k"]))
    return sorted(found)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_keyed_join_both_ways(spark, skewed, rows, facts, dimension, how):
    want = expected(facts, dimension, how)
    assert sorted(tuple(r) for r in keyed_join(facts, dimension, "k", "key", how).collect()) == want
    with skewed():
        joined = keyed_join(facts, dimension, "k", "key", how)
        assert sorted(tuple(r) for r in joined.collect()) == want
        assert joined.columns == (["id", "k", "name"] if how in ("left", "inner") else ["id", "k"])


def test_hot_keys_are_found_and_spread(spark, skewed, facts, dimension):
    assert 7 in frequent_keys(facts, F.col("k"), 0.1)
    with skewed():
        plan = keyed_join(facts, dimension, "k", "key")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "__left_salt" in plan


def test_small_side_is_not_salted(spark, facts, dimension):
    plan = keyed_join(facts, dimension, "k", "key")._jdf.queryExecution().optimizedPlan().toString()
    assert "__left_salt" not in plan


@pytest.mark.parametrize("forced", [False, True])
def test_struct_keys(spark, skewed, forced):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "p string, s bigint")
    right = spark.createDataFrame([("a", 2)], "p string, s bigint").select(F.struct("p", "s").alias("key"))

    def run():
        return sorted(tuple(r) for r in keyed_join(left, right, F.struct("p", "s"), "key", "left_anti").collect())

    if forced:
        with skewed():
            assert run() == [("a", 1), ("b", 1)]
    else:
        assert run() == [("a", 1), ("b", 1)]


def test_lookup_tells_miss_from_null_and_never_fans_out(spark, skewed):
    tracks = spark.createDataFrame([(1, 5), (2, 6), (3, 0), (4, None), (5, 9)], "id bigint, album bigint")
    albums = spark.createDataFrame([(0, "zero"), (5, "a"), (5, "b"), (6, None)], "album_id bigint, title string")

    def run(optional):
        found = lookup(tracks, albums, "album", "album_id", {"t": "title"}, "hit", optional=optional)
        return sorted(tuple(r) for r in found.select("id", or_default("hit", "t", "Unknown"), "hit").collect())

    optional = [(1, "b", True), (2, None, True), (3, "Unknown", False), (4, "Unknown", False), (5, "Unknown", False)]
    mandatory = [(1, "b", True), (2, None, True), (3, "zero", True), (4, "Unknown", False), (5, "Unknown", False)]
    assert run(True) == optional and run(False) == mandatory
    with skewed():
        assert run(True) == optional and run(False) == mandatory


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    kept = one_row_per_key(df, ["k"], [F.desc("id")])
    assert sorted(tuple(r) for r in kept.collect()) == [(0, 99), (1, 97), (2, 98)]
    assert kept._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_related_rows(spark):
    children = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id bigint, parent bigint")
    keys = spark.createDataFrame([(10,), (10,), (None,)], "key bigint")
    assert [tuple(r) for r in related_rows(children, "parent", keys, "key").collect()] == [(1, 10)]


def test_frequent_links_are_searched_in_the_source(spark, skewed, monkeypatch):
    """A chain of lookups searches the table the links stand in, not the joins made before."""
    from keyweave.operators import joins
    from keyweave.plans.catalog import track_items
    from tests.store_data import generated

    searched = []
    real = joins.frequent_keys
    monkeypatch.setattr(joins, "frequent_keys", lambda df, key, *more: searched.append(df) or real(df, key, *more))
    with skewed():
        track_items(generated(spark, Track=50, Album=10, Artist=5, Genre=5, MediaType=5), "now")
    plans = [df._jdf.queryExecution().analyzed().toString() for df in searched]
    assert len(plans) >= 3 and not any("Join" in plan for plan in plans)
