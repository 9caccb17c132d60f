"""Versions of bucketed tables, and indexes that follow them."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from keyweave.operators.access import query_index
from keyweave.plans.store import INDEX1, INDEX2
from keyweave.sources.files import Files
from keyweave.sources.snapshots import Conflict, Snapshots
from keyweave.sources.tables import CollectionStore
from keyweave.specs import IndexSpec

ITEM = "PK string, SK string, v bigint"


def items(spark, *rows, schema=ITEM):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def many(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "many"), ("PK", "SK"))
    store.create(items(spark, *[(f"p{i % 7}", f"s{i:03d}", i) for i in range(200)]), buckets=16)
    return store


def data_files(store):
    """Path and time of every data file."""
    found = {}
    for folder, _, names in os.walk(f"{store.path}/data"):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_a_put_touches_only_its_buckets(spark, many, rows):
    before, parts = data_files(many), many.manifest()["parts"]
    version = many.put(items(spark, ("p1", "s001", -1), ("new", "s", 7)))
    touched = {many.bucket_of(16, "p1", "s001"), many.bucket_of(16, "new", "s")}
    assert 1 <= len(touched) <= 2
    after = many.manifest(version)["parts"]
    assert {b for b in after if after[b] != parts.get(b)} == {str(b) for b in touched}
    files = data_files(many)
    assert all(files[path] == time for path, time in before.items())  # nothing is rewritten
    expected = {(f"p{i % 7}", f"s{i:03d}"): i for i in range(200)} | {("p1", "s001"): -1, ("new", "s"): 7}
    assert rows(many.read()) == sorted((*k, v) for k, v in expected.items())
    assert many.read(0).count() == 200 and rows(many.get("p1", "s001", version=0), "v") == [(1,)]
    assert rows(many.get("p1", "s001"), "v") == [(-1,)] and many.get("p1", "none").count() == 0


def test_a_put_keeps_new_attributes(spark, many, rows):
    many.put(items(spark, ("p1", "s001", 1, "x"), schema=ITEM + ", extra string"))
    many.put(items(spark, ("p2", "s002", 5)))
    assert many.read().columns == ["PK", "SK", "v", "extra"] and many.read().count() == 200
    assert rows(many.read().filter("extra IS NOT NULL"), "SK", "extra") == [("s001", "x")]
    with pytest.raises(AnalysisException):
        many.put(items(spark, ("p1", "s001", "text"), schema="PK string, SK string, v string"))
    assert many.current() == 2  # the refused put left no version


def test_removed_keys_and_emptied_buckets(spark, tmp_path, rows):
    store = Snapshots(spark, str(tmp_path / "t"), ("PK", "SK"))
    store.create(items(spark, ("a", "1", 1), ("b", "1", 2)), buckets=64)
    store.put(items(spark, ("a", "1", 9)), removed=items(spark, ("a", "1", 0), ("b", "1", 0), ("c", "1", 0)))
    assert rows(store.read()) == [("a", "1", 9)]
    store.put(removed=items(spark, ("a", "1", 0)))
    assert store.read().count() == 0 and store.manifest()["parts"] == {}
    assert store.put() == 3 and store.read().columns == ["PK", "SK", "v"]


def test_equal_keys_in_one_put_and_maps(spark, tmp_path, rows):
    schema = "PK string, SK string, v bigint, m map<string,int>"
    store = Snapshots(spark, str(tmp_path / "t"), ("PK", "SK"))
    store.create(items(spark, ("a", "1", 1, {"x": 1}), ("a", "1", 2, {"x": 2}), schema=schema), buckets=2)
    assert [r["m"] for r in store.read().collect()] == [{"x": 2}]
    store.put(items(spark, ("a", "1", 2, {"x": 3}), schema=schema))
    found = store.changes(0, 1).collect()
    assert [(r.old.m, r.new.m) for r in found] == [({"x": 2}, {"x": 3})]


def test_changes_of_two_versions(spark, many):
    many.put(items(spark, ("p1", "s001", 1), ("p2", "s002", -2), ("n", "n", 0)), removed=items(spark, ("p3", "s003", 0)))
    found = {(r.PK, r.SK): (r.old and r.old.v, r.new and r.new.v) for r in many.changes(0, 1).collect()}
    assert found == {("p2", "s002"): (2, -2), ("n", "n"): (None, 0), ("p3", "s003"): (3, None)}
    assert many.changes(1, 1).count() == 0
    many.create(many.read().selectExpr("*", "0 AS w"), buckets=3)
    assert many.changes(1, 2).count() == 200  # other buckets: all are compared, and all have a new column


def test_vacuum_only_when_asked(spark, many, rows):
    for v in range(3):
        many.put(items(spark, ("p1", "s001", v + 1000)))
    assert many.versions() == [0, 1, 2, 3] and many.read(1).filter("v = 1000").count() == 1
    current = rows(many.read())
    assert len(many.vacuum(keep=2)) == 1 and many.versions() == [2, 3]  # the first put's bucket; the rest is in use
    assert rows(many.read()) == current and many.read(2).filter("v = 1001").count() == 1
    with pytest.raises(ValueError):
        many.vacuum(0)


def test_two_writers_of_one_version(spark, many, monkeypatch):
    other = Snapshots(spark, many.path, many.keys)
    monkeypatch.setattr(other, "current", lambda: 0)
    many.put(items(spark, ("p1", "s001", 1)))
    with pytest.raises(Conflict):
        other.put(items(spark, ("p1", "s001", 2)))
    assert many.get("p1", "s001").first()["v"] == 1


def test_files(spark, tmp_path):
    files = Files(spark, str(tmp_path / "f"))
    assert files.names() == [] and files.write_json_once("a", {"x": 1}) and not files.write_json_once("a", {"x": 2})
    assert files.read_json("a") == {"x": 1} and files.names() == ["a"]
    files.remove("a")
    files.remove("a")
    assert files.names() == []


GSI = IndexSpec("GSI1", "GSI1PK", "GSI1SK")
INDEXED = "PK string, SK string, v bigint, GSI1PK string, GSI1SK string"


@pytest.fixture
def store(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "store"))
    rows = [(f"T{i}", "M", i, "ALL" if i % 3 else f"k{i}", f"{i:02d}") for i in range(30)]
    store.create("c", items(spark, *rows, ("T99", "M", 99, None, None), schema=INDEXED), buckets=8)
    store.add_index("c", GSI)
    return store


def index_rows(store, index=GSI):
    return sorted((r[index.partition], r[index.sort] or "", r.PK) for r in store.read_index("c", index).collect())


def expected_index(store, index=GSI):
    found = store.read("c").filter(f"{index.partition} IS NOT NULL AND {index.partition} <> ''").collect()
    return sorted((r[index.partition], r[index.sort] or "", r.PK) for r in found)


def test_an_index_follows_every_put(spark, store, rows):
    assert index_rows(store) == expected_index(store) and len(index_rows(store)) == 30
    moved = items(spark, ("T1", "M", 1, "moved", "01"), ("T2", "M", 2, None, None), ("T3", "M", 3, "", "x"), ("T99", "M", 9, "new", "9"), schema=INDEXED)
    store.upsert("c", moved, removed=items(spark, ("T4", "M", 0)))
    found = index_rows(store)
    assert found == expected_index(store)
    assert ("moved", "01", "T1") in found and ("new", "9", "T99") in found
    assert not {"T2", "T3", "T4"} & {pk for *_, pk in found} and ("ALL", "01", "T1") not in found
    # An attribute that is no index key changes in the index, too.
    store.upsert("c", items(spark, ("T5", "M", 500, "ALL", "05", "e"), schema=INDEXED + ", extra string"))
    assert rows(query_index(store.read_index("c", GSI), GSI, "ALL", "05"), "PK", "v", "extra") == [("T5", 500, "e")]


def test_an_index_left_behind_catches_up(spark, store):
    store.items("c").put(items(spark, ("T7", "M", 7, "late", "7"), schema=INDEXED))  # the writer stopped here
    store.items("c").put(items(spark, ("T8", "M", 8, "later", "8"), schema=INDEXED))
    assert ("late", "7", "T7") in index_rows(store) and index_rows(store) == expected_index(store)


def test_untouched_index_files_stay(spark, store):
    index = store._index("c", GSI)
    before = data_files(index)
    store.upsert("c", items(spark, ("T1", "M", 1, "ALL", "changed"), schema=INDEXED))
    after = data_files(index)
    assert all(after[path] == time for path, time in before.items())
    parts = [index.manifest(v)["parts"] for v in index.versions()]
    assert len({b for b in parts[1] if parts[1][b] != parts[0].get(b)}) == 1


def test_recreated_and_dropped_collections(spark, store):
    assert not store.create("c", items(spark, ("a", "1", 1)))
    assert store.create("c", items(spark, ("a", "1", 1, "k", "1"), schema=INDEXED), force=True)
    assert index_rows(store) == [("k", "1", "a")]
    store.vacuum("c")
    assert store.items("c").versions() == [1] and index_rows(store) == [("k", "1", "a")]
    store.drop("c")
    store.drop("c")
    assert not store.exists("c") and store.indexes("c") == []


def test_a_put_replaces_keys_with_null_parts_and_reduces_frequent_ones(spark, skewed, tmp_path):
    schema = "k string, s string, v bigint"
    store = Snapshots(spark, str(tmp_path), ("k", "s"))
    with skewed():
        store.create(spark.createDataFrame([("a", None, 1), ("b", "1", 1), ("c", "1", 1)], schema), 3)
        hot = spark.range(3000).select(F.lit("b").alias("k"), F.lit("1").alias("s"), F.col("id").alias("v"))
        more = spark.createDataFrame([("a", None, 2), ("d", "1", 5)], schema)
        store.put(hot.unionByName(more), removed=spark.createDataFrame([("c", "1"), ("d", "1")], "k string, s string"), version=("v",))
        found = sorted(map(tuple, store.read().collect()))
    assert found == [("a", None, 2), ("b", "1", 2999), ("d", "1", 5)]


def test_changes_are_found_once_for_all_indexes(spark, monkeypatch, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    schema = "PK string, SK string, GSI1PK string, GSI1SK string, GSI2PK string, GSI2SK string"
    store.create("c", spark.createDataFrame([("a", "1", "x", "1", "y", "1"), ("b", "1", "x", "2", "y", "2")], schema))
    for index in (INDEX1, INDEX2):
        store.add_index("c", index)
    asked, changes = [], Snapshots.changes
    monkeypatch.setattr(Snapshots, "changes", lambda self, *at: asked.append(at) or changes(self, *at))
    store.upsert("c", spark.createDataFrame([("a", "1", "z", "1", None, None)], schema))
    assert sorted(r.GSI1PK for r in store.read_index("c", INDEX1).collect()) == ["x", "z"]
    assert [r.PK for r in store.read_index("c", INDEX2).collect()] == ["b"]
    assert asked == [(0, 1)]
