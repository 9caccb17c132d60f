"""Link tables stored beside what they refer to."""

import pytest
from pyspark.sql import functions as F

from keyweave.plans.playlist import playlist_track_items, store_bridge, stored_playlist_track_items
from keyweave.sources.colocated import CoLocated
from tests.store_data import generated


def tables(spark):
    made = generated(spark, Track=300, Playlist=10)
    bridge = spark.range(6000).select(
        (F.col("id") % 10).alias("PlaylistId"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 > 0, F.col("id") % 400).alias("TrackId")
    )
    return {**{t: made[t] for t in made}, "PlaylistTrack": bridge}


@pytest.mark.parametrize("forced", [False, True])
def test_the_same_items_without_an_exchange(spark, skewed, rows, forced):
    data = tables(spark)

    def check():
        pair = store_bridge(spark, data, buckets=6)
        found = stored_playlist_track_items(pair, "now")
        columns = ["PK", "SK", "TrackName", "ArtistName", "AlbumTitle", "TrackDuration", "UnitPrice"]
        assert rows(found, *columns) == rows(playlist_track_items(data, "now"), *columns)
        apart = spark.read.parquet(f"{pair.root}/links_apart")
        popular = data["PlaylistTrack"].filter("TrackId = 7").count()  # a third of all rows
        assert popular > 2000 and apart.filter("TrackId IS NOT NULL").count() == (popular if forced else 0)
        assert apart.filter("TrackId IS NULL").count() == data["PlaylistTrack"].filter("TrackId IS NULL").count()
        pair.drop()

    if forced:
        with skewed():
            check()
    else:
        check()


def test_no_exchange_on_either_side(spark, skewed):
    with skewed():
        pair = store_bridge(spark, tables(spark), buckets=6)
        plan = stored_playlist_track_items(pair, "now")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "hashpartitioning" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange") == 1
        pair.drop()


def test_repeated_targets_and_empty_sides(spark, rows):
    links = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 9)], "id int, k int")
    targets = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c")], "k2 int, v string")
    pair = CoLocated(spark)
    pair.write(links, "k", targets, "k2", buckets=2)
    assert rows(pair.joined({"v": "v"}, "found")) == [(1, 5, "b", True), (2, 5, "b", True), (3, None, None, False), (4, 9, None, False)]
    pair.drop()
    empty = CoLocated(spark)
    empty.write(links.limit(0), "k", targets.limit(0), "k2", buckets=2)
    assert empty.joined({"v": "v"}, "found").count() == 0
    empty.drop()
