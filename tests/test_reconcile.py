import pytest
from pyspark.sql import functions as F

from keyweave.operators import reconcile
from keyweave.plans.build import build_all
from keyweave.plans.store import COLLECTIONS
from tests.store_data import SAMPLE, generated


@pytest.fixture(scope="module")
def tables(spark):
    return generated(spark, **SAMPLE)


@pytest.fixture(scope="module")
def built(tables):
    return build_all(tables)


def verdict(spark, tables, **collections):
    return {r["collection"]: r for r in reconcile.verdicts(spark, COLLECTIONS, tables, collections).collect()}


def test_sound_collections(spark, tables, built):
    found = verdict(spark, tables, **built)
    assert all(r["valid"] and r["issues"] == [] for r in found.values())
    assert {n: (r["source_count"], r["target_count"]) for n, r in found.items()} == {
        "music_catalog": (48, 18), "customer_data": (18, 8), "playlist_data": (12, 12), "employee_data": (8, 8),
    }
    counts = reconcile.reconcile_counts(COLLECTIONS, tables, built).collect()
    assert all(r["valid"] and r["complete"] and r["target_count"] == r["expected_count"] for r in counts)


def test_unknown_and_missing(spark, tables):
    found = verdict(spark, tables, tickets=None, music_catalog=None)
    assert found["tickets"]["issues"] == ["Unknown collection: tickets"]
    assert found["music_catalog"]["issues"] == ["Collection does not exist: music_catalog"]
    assert not found["tickets"]["valid"] and not found["music_catalog"]["valid"]


def test_empty_collections(spark, tables, built):
    none = {n: df.filter(F.lit(False)) for n, df in built.items()}
    found = verdict(spark, tables, **none)
    assert found["music_catalog"]["issues"] == ["Counts differ: 48 source rows, 0 items", "No items in the collection"]
    assert found["employee_data"]["issues"] == ["Counts differ: 8 source rows, 0 items"]
    empty = generated(spark)
    sound = verdict(spark, empty, employee_data=build_all(empty)["employee_data"], music_catalog=build_all(empty)["music_catalog"])
    assert sound["employee_data"]["valid"] and sound["music_catalog"]["issues"] == ["No items in the collection"]


def test_collections_without_sources_keep_their_line(spark, tables, built):
    only = {"Employee": tables["Employee"]}
    found = verdict(spark, only, employee_data=built["employee_data"], music_catalog=built["music_catalog"])
    assert found["employee_data"]["valid"] and not found["music_catalog"]["valid"]
    assert found["music_catalog"]["issues"] == ["No source table was given"] and found["music_catalog"]["target_count"] > 0
    assert verdict(spark, {}, music_catalog=built["music_catalog"])["music_catalog"]["issues"] == ["No source table was given"]


def test_employee_counts_are_exact(spark, tables, built):
    short = built["employee_data"].filter("EmployeeId > 1")
    assert verdict(spark, tables, employee_data=short)["employee_data"]["issues"] == ["Counts differ: 8 source rows, 7 items"]
    more = built["playlist_data"].unionByName(built["playlist_data"])
    assert not verdict(spark, tables, playlist_data=more)["playlist_data"]["valid"]


def test_every_bad_item_is_found(spark, tables, built):
    bad = built["music_catalog"].withColumns(
        {
            "PK": F.when(F.col("EntityType") == "Artist", F.lit(None)).when(F.col("AlbumId") == 2, F.lit("X#2")).otherwise(F.col("PK")),
            "SK": F.when(F.col("EntityType") == "Album", F.lit(None)).otherwise(F.col("SK")),
            "UpdatedAt": F.lit(None).cast("string"),
            "Name": F.when(F.col("EntityType") == "Track", F.lit(None)).otherwise(F.col("Name")),
            "UnitPrice": F.lit(None).cast("double"),
        }
    )
    tracks_off = bad.filter("EntityType = 'Track' AND PK = 'X#2'").count()
    found = {(r["check"], r["message"]): r["items"] for r in reconcile.item_faults(bad, COLLECTIONS["music_catalog"]).collect()}
    assert found == {
        ("key_presence", "missing PK"): 3,
        ("key_presence", "missing SK"): 5,
        ("key_format", "PK without a known prefix"): tracks_off,
        ("required", "missing UpdatedAt"): 18,
        ("entity_required", "Track without Name, UnitPrice"): 10,
    }


def test_sound_items_are_not_sorted_for_an_example(spark, built):
    items, spec = built["customer_data"], COLLECTIONS["customer_data"]
    broken = items.withColumn("CreatedAt", F.when(F.col("PK") != items.agg(F.min("PK")).scalar(), F.col("CreatedAt")))
    found = reconcile.item_faults(broken.unionByName(items.limit(0)), spec)
    least = broken.filter("CreatedAt IS NULL").agg(F.count("*"), F.min("PK")).first()
    assert [tuple(r) for r in found.collect()] == [("customer_data", "required", "missing CreatedAt", *least)]
    # The lower aggregation, to which items go, has only those with a fault below it.
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Filter" in plan.split("Aggregate")[2].split("Project")[0]
    assert reconcile.item_faults(items, spec).count() == 0


def test_absent_columns_count_as_absent_attributes(spark):
    items = spark.createDataFrame([("EMPLOYEE#1", "PROFILE", "EmployeeProfile", "A", "B")], "PK string, SK string, EntityType string, FirstName string, LastName string")
    found = [r["message"] for r in reconcile.item_faults(items, COLLECTIONS["employee_data"]).collect()]
    assert sorted(found) == ["EmployeeProfile without Title", "missing CreatedAt"]


def test_summary_and_report(spark, tables, built):
    results = reconcile.verdicts(spark, COLLECTIONS, tables, {**built, "playlist_data": None})
    total = reconcile.summary(results).first()
    assert (total["valid"], total["source_count"], total["target_count"]) == (False, 74, 34)
    lines = {r["section"]: r for r in reconcile.report(results).collect()}
    assert lines["SUMMARY"]["status"] == "FAILED" and lines["SUMMARY"]["efficiency"] == pytest.approx(34 / 74 * 100)
    assert lines["employee_data"]["status"] == "PASSED" and lines["playlist_data"]["efficiency"] is None


def test_sample(built):
    assert [r["PK"] for r in reconcile.sample(built["employee_data"], 3).collect()] == ["EMPLOYEE#1", "EMPLOYEE#2", "EMPLOYEE#3"]
