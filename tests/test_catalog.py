import json

import pytest

from keyweave.operators import catalog
from keyweave.operators.ledger import ledger_start
from keyweave.plans.store import TABLES
from keyweave.specs import ForeignKey, TableSpec
from tests.store_data import SAMPLE, generated, hand_made


def test_column_metadata(spark):
    tables = {"Album": hand_made(spark)["Album"]}
    found = {r["column_name"]: r for r in catalog.column_metadata(spark, tables, TABLES).collect()}
    assert (found["AlbumId"]["primary_key"], found["AlbumId"]["nullable"], found["AlbumId"]["position"]) == (True, False, 0)
    assert (found["ArtistId"]["foreign_key"], found["Title"]["foreign_key"]) == ("Artist.ArtistId", None)
    assert found["Title"]["data_type"] == "string"


@pytest.mark.parametrize("exact", [True, False])
def test_column_profile(spark, exact):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "k bigint, v string")
    found = {r["column_name"]: tuple(r)[2:] for r in catalog.column_profile(df, "t", exact).collect()}
    assert found == {"k": (3, 0, 2), "v": (3, 1, 1)}
    empty = {tuple(r)[1:] for r in catalog.column_profile(df.filter("k > 5"), "t", exact).collect()}
    assert empty == {("k", 0, 0, 0), ("v", 0, 0, 0)}


def test_counts(spark):
    found = {r["table_name"]: r["record_count"] for r in catalog.catalog_counts(generated(spark, **SAMPLE)).collect()}
    assert found == {**SAMPLE, "TOTAL": 86}


@pytest.mark.parametrize("forced", [False, True])
def test_orphans(spark, skewed, rows, forced):
    want = [
        ("Album", "ArtistId", "Artist.ArtistId", 1, "Found 1 orphaned records in ArtistId referencing Artist.ArtistId"),
        ("Customer", "SupportRepId", "Employee.EmployeeId", 2),
        ("Employee", "ReportsTo", "Employee.EmployeeId", 2),
        ("InvoiceLine", "InvoiceId", "Invoice.InvoiceId", 1),
        ("PlaylistTrack", "TrackId", "Track.TrackId", 1),
        ("Track", "AlbumId", "Album.AlbumId", 1),
        ("Track", "GenreId", "Genre.GenreId", 2),
        ("Track", "MediaTypeId", "MediaType.MediaTypeId", 1),
    ]

    def check():
        found = rows(catalog.orphans(hand_made(spark), TABLES))
        assert [r[:4] for r in found] == [w[:4] for w in want] and found[0] == want[0]

    if forced:
        with skewed():
            check()
    else:
        check()


def test_relationships(spark):
    found = {r["table_name"]: r for r in catalog.relationships(hand_made(spark), TABLES).collect()}
    assert found["Track"]["references"] == ["Album", "Genre", "MediaType"]
    assert found["Track"]["referenced_by"] == ["InvoiceLine", "PlaylistTrack"]
    assert (found["Artist"]["references"], found["Artist"]["referenced_by"]) == ([], ["Album"])
    assert found["Track"]["incoming_rows"] == 11 and found["Genre"]["outgoing_rows"] == 0


def test_related_rows_by_every_link(spark):
    specs = {
        "Place": TableSpec("Place", ("id",)),
        "Trip": TableSpec("Trip", ("id",), (ForeignKey("start", "Place", "id"), ForeignKey("goal", "Place", "id"))),
    }
    trips = spark.createDataFrame([(1, 5, 6), (2, 6, 5), (3, 5, 5), (4, 6, 7), (5, None, 5)], "id int, start int, goal int")
    tables = {"Place": spark.createDataFrame([(5,), (6,), (7,)], "id int"), "Trip": trips}
    found = catalog.related_data(tables, specs, "Place", spark.createDataFrame([(5,)], "id int"))
    assert sorted(r["id"] for r in found["Trip"].collect()) == [1, 2, 3, 5]


def test_related_rows_by_all_columns_of_a_key(spark):
    specs = {
        "Pair": TableSpec("Pair", ("a", "b")),
        "Use": TableSpec("Use", ("id",), tuple(ForeignKey(c, "Pair", r) for c, r in (("x1", "a"), ("x2", "b"), ("y1", "a"), ("y2", "b")))),
        "Half": TableSpec("Half", ("id",), (ForeignKey("h", "Pair", "a"),)),
    }
    uses = [(1, 1, 2, 9, 9), (2, 1, 9, 1, 2), (3, 1, 9, 2, 2), (4, None, 2, None, None), (5, 1, 2, 1, 2), (6, 2, 1, 2, 1)]
    tables = {
        "Pair": spark.createDataFrame([(1, 2), (2, 2)], "a int, b int"),
        "Use": spark.createDataFrame(uses, "id int, x1 int, x2 int, y1 int, y2 int"),
        "Half": spark.createDataFrame([(1, 1)], "id int, h int"),
    }
    keys = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int")
    found = catalog.related_data(tables, specs, "Pair", keys)
    assert list(found) == ["Use"] and sorted(r["id"] for r in found["Use"].collect()) == [1, 2, 5]
    assert list(catalog.related_data_present(tables, specs, "Pair", keys)) == ["Use"]
    assert catalog.related_data_present(tables, specs, "Pair", keys.filter("a = 7")) == {}


def test_totals_beside_a_table_without_a_name(spark):
    counts = spark.createDataFrame([(None, 2), ("a", 3)], "table_name string, record_count bigint")
    found = {(r["table_name"], r["total"], r["tables"]) for r in ledger_start(counts).collect()}
    assert found == {(None, 2, 1), ("a", 3, 1), ("RUN", 5, 2)}


def test_related_data(spark):
    tables = hand_made(spark)
    keys = spark.createDataFrame([(1,)], "TrackId bigint")
    found = catalog.related_data_present(tables, TABLES, "Track", keys)
    assert {n: df.count() for n, df in found.items()} == {"InvoiceLine": 3, "PlaylistTrack": 1}
    nothing = spark.createDataFrame([(7,)], "TrackId bigint")
    assert catalog.related_data_present(tables, TABLES, "Track", nothing) == {}
    # A link of a table to itself is not followed.
    people = catalog.related_data(tables, TABLES, "Employee", spark.createDataFrame([(2,)], "EmployeeId bigint"))
    assert list(people) == ["Customer"]
    with pytest.raises(ValueError):
        catalog.related_data(tables, TABLES, "Nothing", keys)
    keyless = {**TABLES, "Track": TableSpec("Track")}
    assert catalog.related_data(tables, keyless, "Track", keys) == {}


def test_load_order(spark):
    found = [r["table_name"] for r in catalog.load_order(spark, generated(spark, **SAMPLE), TABLES).collect()]
    assert found[:5] == ["Playlist", "Artist", "MediaType", "Employee", "Genre"]
    assert found.index("Album") < found.index("Track") < found.index("InvoiceLine")
    loop = {
        "a": TableSpec("a", ("k",), (ForeignKey("b", "b", "k"),)),
        "b": TableSpec("b", ("k",), (ForeignKey("a", "a", "k"),)),
        "c": TableSpec("c", ("k",)),
    }
    tables = {n: spark.range(i) for i, n in enumerate(loop)}
    order = catalog.load_order(spark, tables, loop).collect()
    assert [(r["table_name"], r["layer"]) for r in order] == [("c", 0), ("a", 1), ("b", 1)]


def test_schema_analysis_as_json(spark, tmp_path):
    path = str(tmp_path / "analysis")
    catalog.schema_analysis(spark, hand_made(spark), TABLES).write.json(path)
    found = {r["table_name"]: json.loads(r["v"]) for r in spark.read.text(path).selectExpr("get_json_object(value, '$.table_name') AS table_name", "value AS v").collect()}
    assert found["PlaylistTrack"]["primary_keys"] == ["PlaylistId", "TrackId"]
    assert found["Album"]["foreign_keys"] == {"ArtistId": "Artist.ArtistId"} and len(found["Track"]["columns"]) == 9
