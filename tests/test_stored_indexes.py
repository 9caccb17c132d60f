"""Substring search by lists, and profiles kept with versions."""

import os

import pytest
from pyspark.sql import functions as F

from keyweave.operators.access import contains
from keyweave.operators.kept_profile import LG_K, kept_profile
from keyweave.operators.substring import SubstringIndex
from keyweave.sources.snapshots import Snapshots

WORDS = ["Small Ring", "ringing", "ROUND", "spring water", "", None, "in", "Straße", "große ringe", "a.b%c_d", "日本語の歌", "ab", "ring", "aaaa"]


@pytest.fixture(scope="module")
def named(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("named"))
    data = [(f"T{i}", "M", w) for i, w in enumerate(WORDS * 3)] + [(f"X{i}", "M", f"track number {i}") for i in range(300)]
    items = spark.createDataFrame(data, "PK string, SK string, Name string")
    store = Snapshots(spark, f"{folder}/items", ("PK", "SK"))
    store.create(items, buckets=32)
    index = SubstringIndex(spark, f"{folder}/names", "Name")
    index.build(items)
    return store, index


@pytest.mark.parametrize("text", ["ring", "RING", "in", "i", "", "ße", "SSE", "a.b%c_d", "_", "本語", "日本語の歌", "aaa", "aaaaa", "number 29", "zzz", "g w", "rk"])
def test_the_same_rows_as_the_filter(named, rows, text):
    store, index = named
    expected = rows(contains(store.read(), "Name", text), "PK", "SK", "Name")
    assert rows(index.search(store, text), "PK", "SK", "Name") == expected
    assert rows(index.search(store.read(), text), "PK", "SK", "Name") == expected


def test_only_candidates_are_read(named):
    store, index = named
    assert index.candidates("number 299").count() <= 1 + 3
    found = index.search(store, "number 299")
    files = {os.path.dirname(f) for f in found.inputFiles() if "/data/" in f}
    assert 1 <= len(files) <= 4  # of 32 buckets
    assert index.candidates("zzz").count() == 0 and index.rarest("zzzr") == ["ZZR"] or index.rarest("zzzr") == ["ZZZ"]


def test_a_very_frequent_sequence_is_left_out(named):
    _, index = named
    lengths = dict(index.spark.read.parquet(f"{index.path}/lengths").collect())
    chosen = index.rarest("track number 7")
    assert len(chosen) == 4 and max(lengths[g] for g in chosen) <= min(300, *[n for g, n in lengths.items() if g in ("TRA", "RAC", "ACK")])


def exact(rows, columns):
    return {c: (len(rows), sum(r.get(c) is None for r in rows), len({r[c] for r in rows if r.get(c) is not None})) for c in columns}


def measured(store, version=None):
    return {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in kept_profile(store, version).collect()}


def close(found, expected):
    """Counts are exact; a distinct count is within four standard errors."""
    bound = 4 * 1.04 / 2 ** (LG_K / 2)
    for c, (n, nulls, distinct) in expected.items():
        assert found[c][:2] == (n, nulls) and abs(found[c][2] - distinct) <= max(1, bound * distinct), c


def test_a_profile_follows_puts(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"), ("PK",))
    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("PK"), (F.col("id") % 5000).alias("v"), F.when(F.col("id") % 4 > 0, F.lit("x")).alias("s"))
    store.create(df, buckets=8)
    rows = {f"k{i}": {"PK": f"k{i}", "v": i % 5000, "s": "x" if i % 4 else None} for i in range(20000)}
    close(measured(store), exact(list(rows.values()), ("PK", "v", "s")))
    put = spark.createDataFrame([("k0", -1, "new", 1.5), ("n1", -2, None, None)], "PK string, v bigint, s string, extra double")
    store.put(put, removed=df.filter("v >= 4000").select("PK"))
    rows = {k: r for k, r in rows.items() if r["v"] < 4000}
    rows |= {"k0": {"PK": "k0", "v": -1, "s": "new", "extra": 1.5}, "n1": {"PK": "n1", "v": -2, "s": None}}
    close(measured(store), exact(list(rows.values()), ("PK", "v", "s", "extra")))
    close(measured(store, 0), {"PK": (20000, 0, 20000), "v": (20000, 0, 5000), "s": (20000, 5000, 1)})


def test_after_a_put_only_its_write_is_read(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"), ("PK",))
    store.create(spark.range(1000).select(F.col("id").cast("string").alias("PK"), "id"), buckets=8)
    kept_profile(store).collect()
    (first,) = os.listdir(f"{store.path}/profiles")
    before = os.stat(f"{store.path}/profiles/{first}/_SUCCESS").st_mtime_ns
    # The data of the first write is out of reach now: a profile that read it again would fail.
    os.rename(f"{store.path}/data/{first}", f"{store.path}/data/hidden")
    store_only_new = store.spark.createDataFrame([("new", 1)], "PK string, id bigint")
    untouched = store.manifest()["parts"]
    version = store.current()
    write, there = store._write(store_only_new.withColumn("__bucket", store._bucket(8)))
    manifest = store.manifest(version) | {"parts": untouched | {str(b): write for b in there}}
    store._commit(version + 1, manifest)
    found = measured(store)
    assert found["PK"][0] < 1000 and os.stat(f"{store.path}/profiles/{first}/_SUCCESS").st_mtime_ns == before
    assert sorted(os.listdir(f"{store.path}/profiles")) == sorted([first, write])


def test_profile_of_an_empty_version(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"), ("PK",))
    store.create(spark.createDataFrame([], "PK string, m map<string,int>"), buckets=4)
    assert measured(store) == {"PK": (0, 0, 0), "m": (0, 0, 0)}
    store.put(spark.createDataFrame([("a", {"x": 1}), ("b", {"x": 1})], "PK string, m map<string,int>"))
    assert measured(store) == {"PK": (2, 0, 2), "m": (2, 0, 1)}
