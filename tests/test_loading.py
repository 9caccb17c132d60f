import json
import os
import sqlite3

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from keyweave.functions.codec import encode_items
from keyweave.operators.upsert import keyed_upsert, latest, not_yet_written
from keyweave.plans.build import build
from keyweave.sources import sink
from keyweave.sources.sqlite import discover, read_sqlite, read_sqlite_store
from keyweave.sources.tables import CollectionStore, TableSet
from keyweave.streaming.incremental import DeltaLog, PutLog, load_new_files
from tests.store_data import generated


def items(spark, *rows):
    return spark.createDataFrame(rows, "PK string, SK string, v bigint")


def test_upsert_replaces_whole_items(spark, rows):
    old = items(spark, ("a", "1", 1), ("b", "1", 9))
    new = spark.createDataFrame([("b", "1", None, "x"), ("b", "1", 3, "y"), ("c", "1", 4, None)], "PK string, SK string, v bigint, extra string")
    found = rows(keyed_upsert(old, new), "PK", "SK", "v", "extra")
    assert found == [("a", "1", 1, None), ("b", "1", 3, "y"), ("c", "1", 4, None)]
    assert rows(keyed_upsert(keyed_upsert(old, new), new), "PK", "v") == rows(keyed_upsert(old, new), "PK", "v")


def test_upsert_of_items_with_maps(spark):
    old = spark.createDataFrame([("a", "1", {"x": 1})], "PK string, SK string, m map<string,bigint>")
    new = spark.createDataFrame([("a", "1", {"x": 2})], "PK string, SK string, m map<string,bigint>")
    assert [r["m"] for r in keyed_upsert(old, new).collect()] == [{"x": 2}]


def test_latest_with_a_hot_key(spark):
    df = spark.range(1000).select(F.lit("hot").alias("PK"), F.lit("1").alias("SK"), F.col("id").alias("v"))
    assert [tuple(r) for r in latest(df, ["v"]).collect()] == [("hot", "1", 999)]


@pytest.mark.parametrize("forced", [False, True])
def test_not_yet_written(spark, skewed, rows, forced):
    every = items(spark, ("a", "1", 1), ("a", "2", 2), ("b", "1", 3))
    written = items(spark, ("a", "2", 0), ("a", "2", 0))
    if forced:
        with skewed():
            assert rows(not_yet_written(every, written), "v") == [(1,), (3,)]
    else:
        assert rows(not_yet_written(every, written), "v") == [(1,), (3,)]


class Flaky:
    """Takes only some items of each call, or refuses whole calls."""

    def __init__(self, takes, errors=()):
        self.takes, self.errors, self.calls, self.stored = takes, list(errors), 0, []

    def put(self, table, batch):
        self.calls += 1
        if self.errors:
            raise self.errors.pop(0)
        self.stored += batch[: self.takes]
        return batch[self.takes :]


def test_retry_sends_only_leftovers_and_waits_longer():
    waits, client = [], Flaky(10)
    left, retries = sink.put_batch(client.put, "t", [str(i) for i in range(25)], wait=waits.append)
    assert (left, retries, client.calls) == ([], 2, 3) and waits == [0.1, 0.2]
    assert sorted(client.stored, key=int) == [str(i) for i in range(25)]


def test_retries_are_bounded_and_leftovers_reported():
    waits, client = [], Flaky(1)
    left, retries = sink.put_batch(client.put, "t", list("abcdefgh"), wait=waits.append)
    assert (left, retries, client.calls) == (list("efgh"), 3, 4) and waits == [0.1, 0.2, 0.4]


def test_throttling_waits_longer_and_other_errors_not_at_all():
    waits = []
    client = Flaky(9, [sink.Throttled(), sink.StoreError(), sink.Throttled()])
    assert sink.put_batch(client.put, "t", ["a"], wait=waits.append) == ([], 3)
    assert waits == [0.5, 2.0]
    always = Flaky(9, [sink.Throttled()] * 9)
    assert sink.put_batch(always.put, "t", ["a"], wait=waits.append) == (["a"], 3)


@pytest.mark.parametrize("size, sizes", [(25, [25, 25, 10]), (100, [25, 25, 10]), (7, [7] * 8 + [4])])
def test_writer_batches_and_dead_letters(tmp_path, monkeypatch, size, sizes):
    seen = []

    class Client:
        def __init__(self, _):
            pass

        def put(self, table, batch):
            seen.append(len(batch))
            return [i for i in batch if i == "13"]

    monkeypatch.setattr(sink, "FolderClient", Client)
    monkeypatch.setattr(sink.time, "sleep", lambda _: None)
    options = {"table": "t", "batch_size": str(size), "max_retries": "0", "dead_letters": str(tmp_path / "dead"), "summary": str(tmp_path / "s")}
    writer = sink.BatchWriter(options)
    result = writer.write(iter([Row(item=str(i)) for i in range(60)]))
    assert (result.written, result.unprocessed, result.batches) == (59, 1, len(sizes))
    assert [n for n in seen if n > 1] == sizes
    dead = [line for f in os.listdir(tmp_path / "dead") for line in open(tmp_path / "dead" / f)]
    assert dead == ["13\n"]
    writer.commit([result, None, result])
    summary = [json.loads(line) for f in os.listdir(tmp_path / "s") for line in open(tmp_path / "s" / f)]
    assert summary[0]["written"] == 118 and summary[0]["unprocessed"] == 2


def test_sink_from_spark(spark, tmp_path):
    people = build(["employee_data"], generated(spark, Employee=60))["employee_data"]
    folder = str(tmp_path)
    outcome = sink.put_items(encode_items(people), "employee_data", folder).first()
    assert (outcome["written"], outcome["unprocessed"]) == (60, 0)
    assert sink.read_put_items(spark, folder, "employee_data").distinct().count() == 60


def test_the_folder_client_keeps_one_file_a_task_and_the_last_put(spark, tmp_path):
    def item(pk, value):
        return json.dumps({"PK": {"S": pk}, "SK": {"S": "1"}, "Name": {"S": value}})

    client = sink.FolderClient(str(tmp_path / "items"))
    for value in ("z", "y", "a"):
        client.put("t", [item("p", value), item(f"q{value}", "tab\t")])
    (name,) = os.listdir(tmp_path / "items" / "t")
    with open(tmp_path / "items" / "t" / name, "a") as f:
        f.write(item("p", "cut off")[:-3])
    found = sorted(r.item for r in sink.read_put_items(spark, str(tmp_path), "t").collect())
    assert found == sorted([item("p", "a"), *[item(f"q{v}", "tab\t") for v in "zya"]])


def test_collection_store(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path), prefix="store_test_")
    first, second = items(spark, ("a", "1", 1)), items(spark, ("a", "1", 2), ("b", "1", 3))
    assert not store.exists("x") and store.item_count("x") == 0
    assert store.create("x", first) and not store.create("x", second) and store.item_count("x") == 1
    store.upsert("x", second)
    assert sorted(tuple(r) for r in store.read("x").collect()) == [("a", "1", 2), ("b", "1", 3)]
    assert store.create("x", first, force=True) and store.item_count("x") == 1
    assert {tuple(r) for r in store.statistics(["x", "y"]).collect()} == {("x", True, 1), ("y", False, 0)}
    store.drop("x")
    store.drop("x")
    assert not store.exists("x")


def test_tables_open_on_first_use():
    opened = []
    tables = TableSet({n: (lambda n=n: opened.append(n) or n) for n in ("a", "b")})
    assert "a" in tables and len(tables) == 2 and list(tables) == ["a", "b"] and opened == []
    assert tables["b"] == "b" and tables["b"] == "b" and opened == ["b"] and tables.get("c") is None


def test_delta_log(spark, tmp_path, rows):
    log = DeltaLog(spark, str(tmp_path / "log"))
    log.append(items(spark, ("a", "1", 5), ("b", "1", 1), ("b", "1", 2)), 0)
    log.append(items(spark, ("a", "1", 3)), 1)
    log.append(items(spark, ("a", "1", 3)), 1)
    assert rows(log.read()) == [("a", "1", 3), ("b", "1", 2)] and log.all_writes().count() == 3
    folded = log.compact(str(tmp_path / "folded"))
    assert rows(folded.read()) == rows(log.read()) and folded.all_writes().count() == 2


def test_a_batch_repeated_after_a_fold_changes_nothing(spark, tmp_path, rows):
    log = DeltaLog(spark, str(tmp_path / "log"))
    log.append(items(spark, ("a", "1", 1), ("b", "1", 2)), 0)
    log.append(items(spark, ("b", "1", 3)), 1)
    folded = log.compact(str(tmp_path / "folded"))
    assert folded.append(items(spark, ("b", "1", 3)), 1) is False
    assert rows(folded.read()) == [("a", "1", 1), ("b", "1", 3)]
    assert folded.append(items(spark, ("c", "1", 4)), 2)
    assert rows(folded.read()) == [("a", "1", 1), ("b", "1", 3), ("c", "1", 4)]


def test_put_log(spark, tmp_path, rows):
    log = PutLog(spark, str(tmp_path / "log"), version=("v",), buckets=4)
    with pytest.raises(ValueError):
        log.read()
    assert log.append(items(spark, ("a", "1", 5), ("b", "1", 2), ("b", "1", 1)), 0)
    assert log.append(items(spark, ("a", "1", 3), ("a", "1", 2)), 1)
    assert not log.append(items(spark, ("a", "1", 9)), 1) and not log.append(items(spark, ("a", "1", 9)), 0)
    assert rows(log.read()) == [("a", "1", 3), ("b", "1", 2)] and log.upto() == 1
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_a_later_batch_with_another_column(spark, tmp_path, rows):
    log = DeltaLog(spark, str(tmp_path / "log"))
    log.append(items(spark, ("a", "1", 1), ("b", "1", 2)), 0)
    log.append(spark.createDataFrame([("b", "1", 3, "x")], "PK string, SK string, v bigint, extra string"), 1)
    expected = [("a", "1", 1, None), ("b", "1", 3, "x")]
    assert rows(log.read(), "PK", "SK", "v", "extra") == expected
    assert rows(log.compact(str(tmp_path / "folded")).read(), "PK", "SK", "v", "extra") == expected


@pytest.mark.parametrize("kind", [DeltaLog, PutLog])
def test_incremental_load_reads_only_new_files(spark, tmp_path, rows, kind):
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "checkpoint")
    log = kind(spark, str(tmp_path / "log"))
    first = items(spark, ("a", "1", 1), ("b", "1", 2))

    def load():
        return load_new_files(spark, source, first.schema, lambda df: df.withColumn("v", F.col("v") * 10), log, checkpoint)

    first.write.parquet(source)
    assert load() == 2 and load() == 0
    items(spark, ("b", "1", 7), ("c", "1", 3)).write.mode("append").parquet(source)
    assert load() == 2
    assert rows(log.read()) == [("a", "1", 10), ("b", "1", 70), ("c", "1", 30)]


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "store.sqlite")
    with sqlite3.connect(path) as db:
        db.executescript(
            """CREATE TABLE Artist (ArtistId INTEGER PRIMARY KEY, Name NVARCHAR(120) DEFAULT 'x');
            CREATE TABLE Album (AlbumId INTEGER PRIMARY KEY, Title TEXT NOT NULL, ArtistId INTEGER REFERENCES Artist(ArtistId), Price NUMERIC(10,2));
            CREATE TABLE Pair (A INTEGER REFERENCES Album, B INTEGER, PRIMARY KEY (A, B)) WITHOUT ROWID;
            CREATE TABLE Empty (Id INTEGER PRIMARY KEY);
            CREATE INDEX by_artist ON Album (ArtistId);"""
        )
        db.executemany("INSERT INTO Artist VALUES (?, ?)", [(i * 3, f"Artist {i}" if i % 10 else None) for i in range(1, 101)])
        db.executemany("INSERT INTO Album VALUES (?, ?, ?, ?)", [(1, "T", 3, 0.99), (2, "U", None, 1), (3, 4, 6, "2.5")])
        db.executemany("INSERT INTO Pair VALUES (?, ?)", [(1, 2), (2, 3)])
    db.close()
    return path


def test_sqlite_source(spark, database):
    artists = read_sqlite(spark, database, "Artist", partitions=5)
    assert artists.dtypes == [("ArtistId", "bigint"), ("Name", "string")]
    assert artists.rdd.getNumPartitions() == 5
    found = {r["ArtistId"]: r["Name"] for r in artists.collect()}
    assert len(found) == 100 and found[3] == "Artist 1" and found[30] is None
    tables = read_sqlite_store(spark, database)
    assert set(tables) == {"Artist", "Album", "Pair", "Empty"}
    assert {tuple(r) for r in tables["Album"].collect()} == {(1, "T", 3, 0.99), (2, "U", None, 1.0), (3, "4", 6, 2.5)}
    assert {tuple(r) for r in tables["Pair"].collect()} == {(1, 2), (2, 3)} and tables["Empty"].count() == 0


def test_sqlite_filters_reach_the_file(spark, database):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = read_sqlite(spark, database, "Artist").filter("ArtistId > 290 AND Name IS NOT NULL")
        assert sorted(r["ArtistId"] for r in found.collect()) == [291, 294, 297]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_sqlite_discovery(database):
    specs = discover(database)
    assert specs["Album"].primary_key == ("AlbumId",) and specs["Pair"].primary_key == ("A", "B")
    assert [fk.target for fk in specs["Album"].foreign_keys] == ["Artist.ArtistId"]
    assert [fk.target for fk in specs["Pair"].foreign_keys] == ["Album.AlbumId"]
    assert specs["Album"].indexes == ("by_artist",) and specs["Artist"].defaults == {"Name": "'x'"}
