import pytest
from pyspark.sql import functions as F

from keyweave.functions.codec import encode_items
from keyweave.operators import access
from keyweave.operators.reconcile import transform_summary
from keyweave.plans.build import build, build_all
from keyweave.plans.customer import invoice_items
from keyweave.plans.items import now_stamp
from keyweave.plans.store import COLLECTIONS, INDEX1, INDEX2
from tests.store_data import FULL, SAMPLE, generated, hand_made

STAMP = "2024-01-01T00:00:00"


@pytest.fixture(scope="module")
def items(spark):
    found = {}
    for df in build_all(hand_made(spark), STAMP).values():
        for r in df.collect():
            found[r["PK"], r["SK"]] = {k: v for k, v in r.asDict(recursive=True).items() if v is not None}
    return found


def common(item):
    return {k: v for k, v in item.items() if k not in ("CreatedAt", "UpdatedAt", "PK", "SK")}


def test_stamps_are_one_per_run(items):
    assert {(i["CreatedAt"], i["UpdatedAt"]) for i in items.values()} == {(STAMP, STAMP)}


def test_artist(items):
    assert common(items["ARTIST#1", "METADATA"]) == {
        "EntityType": "Artist", "ArtistId": 1, "Name": "Abba", "GSI1PK": "ARTIST", "GSI1SK": "ABBA",
        "GSI2PK": "SEARCH#ABBA", "GSI2SK": "ARTIST#1",
    }
    nameless = items["ARTIST#2", "METADATA"]
    assert "Name" not in nameless and nameless["GSI1SK"] == "" and nameless["GSI2PK"] == "SEARCH#"


def test_album(items):
    assert common(items["ALBUM#1", "METADATA"]) == {
        "EntityType": "Album", "AlbumId": 1, "Title": "Gold", "ArtistId": 1, "ArtistName": "Abba", "GSI1PK": "ARTIST#1",
        "GSI1SK": "ALBUM#GOLD", "GSI2PK": "SEARCH#GOLD", "GSI2SK": "ALBUM#1",
    }
    assert items["ALBUM#3", "METADATA"]["ArtistName"] == "Unknown Artist"
    assert items["ALBUM#4", "METADATA"]["ArtistName"] == "Zero"
    assert "ArtistName" not in items["ALBUM#2", "METADATA"]


def test_track_with_everything(items):
    assert common(items["TRACK#1", "METADATA"]) == {
        "EntityType": "Track", "TrackId": 1, "Name": "One", "Composer": "A", "Milliseconds": 100, "Bytes": 10, "UnitPrice": 0.99,
        "MediaTypeId": 1, "MediaTypeName": "Disc", "AlbumId": 1, "AlbumTitle": "Gold", "ArtistId": 1, "ArtistName": "Abba",
        "GenreId": 1, "GenreName": "Pop", "GSI1PK": "ALBUM#1", "GSI1SK": "TRACK#ONE", "GSI2PK": "SEARCH#ONE", "GSI2SK": "TRACK#1",
    }


@pytest.mark.parametrize("track", [2, 3, 4])
def test_track_without_album_or_genre(items, track):
    """Id 0, NULL and an orphan id all mean: no link."""
    item = items[f"TRACK#{track}", "METADATA"]
    assert item["GSI1PK"] == "NO_ALBUM" and item["ArtistName"] == "Unknown Artist"
    assert not {"AlbumId", "AlbumTitle", "ArtistId", "GenreId", "GenreName"} & set(item)


def test_track_values(items):
    two, three, five = (items[f"TRACK#{i}", "METADATA"] for i in (2, 3, 5))
    assert two["MediaTypeName"] == "File" and two["UnitPrice"] == 0.0 and "Composer" not in two and "Milliseconds" not in two
    assert three["MediaTypeName"] == "Unknown" and three["GSI1SK"] == "TRACK#" and "Name" not in three
    assert "GenreName" not in five and five["GenreId"] == 2 and "ArtistName" not in five and five["AlbumTitle"] == "Bare"
    assert items["TRACK#6", "METADATA"]["ArtistName"] == "Unknown Artist"
    assert items["TRACK#7", "METADATA"]["ArtistName"] == "Zero"


def test_customer(items):
    one, two, three, four = (items[f"CUSTOMER#{i}", "PROFILE"] for i in (1, 2, 3, 4))
    assert (one["GSI1PK"], one["GSI1SK"], one["GSI2PK"], one["GSI2SK"]) == ("gus@x.io", "CUSTOMER#1", "SUPPORT_REP#2", "CUSTOMER#1")
    assert (one["SupportRepId"], one["SupportRepName"], one["Company"], one["Fax"]) == (2, "Bob", "", "")
    for unlinked in (two, three):
        assert not {"SupportRepId", "SupportRepName", "GSI2PK", "GSI2SK", "GSI1PK"} & set(unlinked)
    assert (four["SupportRepId"], four["SupportRepName"]) == (88, "")


def test_invoice(items):
    ten = items["CUSTOMER#1", "INVOICE#10"]
    assert ten["InvoiceLines"] == [
        {"InvoiceLineId": 1, "TrackId": 2, "UnitPrice": 1.5, "Quantity": 1, "LineTotal": 1.5},
        {"InvoiceLineId": 2, "TrackId": 3, "UnitPrice": 0.0, "Quantity": 4, "LineTotal": 0.0},
        {"InvoiceLineId": 3, "TrackId": 1, "UnitPrice": 0.5, "Quantity": 2, "LineTotal": 1.0},
    ]
    assert ten["LineCount"] == 3 and "GSI1PK" not in ten and ten["BillingCity"] == ""
    eleven = items["CUSTOMER#1", "INVOICE#11"]
    assert eleven["InvoiceLines"] == [] and eleven["LineCount"] == 0 and eleven["Total"] == 0.0
    assert "InvoiceDate" not in items["CUSTOMER#2", "INVOICE#12"]
    assert not [k for k in items if k[1] == "INVOICE#99"]


def test_empty_line_list_is_not_encoded(spark):
    encoded = encode_items(invoice_items(hand_made(spark), STAMP))
    texts = [r["item"] for r in encoded.collect()]
    assert sum("InvoiceLines" in t for t in texts) == 2 and len(texts) == 3


def test_invoice_pages(spark):
    pages = {r["SK"]: r for r in invoice_items(hand_made(spark), STAMP, page_size=2).collect()}
    assert set(pages) == {"INVOICE#10", "INVOICE#10#PAGE#000000000001", "INVOICE#11", "INVOICE#12"}
    first, second = pages["INVOICE#10"], pages["INVOICE#10#PAGE#000000000001"]
    assert (first["EntityType"], second["EntityType"]) == ("Invoice", "InvoicePage")
    assert [line["InvoiceLineId"] for line in first["InvoiceLines"]] == [1, 2]
    assert [line["InvoiceLineId"] for line in second["InvoiceLines"]] == [3]
    assert first["LineCount"] == second["LineCount"] == 3


def test_playlist(items):
    assert common(items["PLAYLIST#1", "METADATA"]) == {"EntityType": "Playlist", "PlaylistId": 1, "Name": "All"}
    assert common(items["PLAYLIST#1", "TRACK#1"]) == {
        "EntityType": "PlaylistTrack", "PlaylistId": 1, "TrackId": 1, "TrackName": "One", "ArtistName": "Abba", "AlbumTitle": "Gold",
        "TrackDuration": 100, "UnitPrice": 0.99,
    }
    missing = items["PLAYLIST#2", "TRACK#1000"]
    assert [missing[c] for c in ("TrackName", "ArtistName", "AlbumTitle", "TrackDuration", "UnitPrice")] == [
        "Unknown Track", "Unknown Artist", "Unknown Album", 0, 0.0,
    ]
    assert "TrackName" not in items["PLAYLIST#1", "TRACK#3"] and items["PLAYLIST#1", "TRACK#2"]["AlbumTitle"] == "Unknown Album"


def test_employee(items):
    one, two, three, four = (items[f"EMPLOYEE#{i}", "PROFILE"] for i in (1, 2, 3, 4))
    for top in (one, three):
        assert not {"ReportsTo", "ManagerName", "GSI1PK", "GSI1SK"} & set(top)
    assert (two["ReportsTo"], two["ManagerName"], two["GSI1PK"], two["GSI1SK"]) == (1, "Ann Lee", "MANAGER#1", "EMPLOYEE#2")
    assert four["ManagerName"] == "" and "Title" not in four and three["Email"] == ""


def test_shuffled_joins_give_the_same_items(spark, skewed, items):
    with skewed():
        for df in build_all(hand_made(spark), STAMP).values():
            for r in df.collect():
                assert items[r["PK"], r["SK"]] == {k: v for k, v in r.asDict(recursive=True).items() if v is not None}


@pytest.mark.parametrize(
    "sizes, due",
    [(FULL, (4125, 471, 8733, 8)), (SAMPLE, (18, 8, 12, 8)), ({"Artist": 20, "Album": 50, "Track": 100}, (170, 0, 0, 0))],
)
def test_item_counts(spark, sizes, due):
    tables = generated(spark, **sizes)
    assert tuple(df.count() for df in build_all(tables).values()) == due
    summary = {(r["side"], r["name"]): r for r in transform_summary(COLLECTIONS, tables).collect()}
    assert summary["target", "TOTAL"]["records"] == sum(due)
    assert summary["source", "TOTAL"]["records"] == sum(sizes.values())
    assert summary["efficiency", "TOTAL"]["percent"] == pytest.approx(sum(due) / sum(sizes.values()) * 100)


def test_store_without_classifications(spark):
    """A schema without genre and media tables, and without a composer column."""
    tables = {k: v for k, v in generated(spark, Artist=2, Album=3, Track=9).items() if k in ("Artist", "Album", "Track")}
    rows = build(["music_catalog"], tables)["music_catalog"].filter("EntityType = 'Track'").collect()
    assert {(r["Composer"], r["MediaTypeName"], r["GenreName"]) for r in rows} == {("", "Unknown", None)} and len(rows) == 9


def test_build_rejects_unknown_names_and_reads_only_what_it_needs(spark):
    tables = {"Employee": hand_made(spark)["Employee"]}
    assert build(["employee_data"], tables)["employee_data"].count() == 4
    with pytest.raises(ValueError, match="tickets"):
        build(["employee_data", "tickets"], tables)


def test_access_patterns_match_the_normalised_joins(spark):
    tables = generated(spark, **FULL)
    music, customers = build(["music_catalog", "customer_data"], tables).values()
    artist = tables["Artist"].withColumnRenamed("Name", "ArtistName")
    joined = tables["Track"].join(tables["Album"], "AlbumId").join(artist, "ArtistId")
    track = access.get_item(music, "TRACK#77", "METADATA").select("Name", "AlbumTitle", "ArtistName").collect()
    assert track == joined.filter("TrackId = 77").select("Name", F.col("Title").alias("AlbumTitle"), "ArtistName").collect()
    of_album = access.query_index(music, INDEX1, "ALBUM#5").collect()
    assert [r["GSI1SK"] for r in of_album] == sorted(r["GSI1SK"] for r in of_album)
    assert len(of_album) == tables["Track"].filter("AlbumId = 5").count()
    assert access.query_index(music, INDEX1, "ARTIST#3").count() == tables["Album"].filter("ArtistId = 3").count()
    found = access.search_name(music, INDEX2, "track 12").collect()
    assert [r["PK"] for r in found] == ["TRACK#12"]
    assert access.contains(music, "Name", "RACK 12").count() == joined.filter("upper(Name) LIKE '%RACK 12%'").count()
    history = access.query_partition(customers, "CUSTOMER#4")
    assert [r["SK"] for r in history.collect()] == sorted(r["SK"] for r in history.collect())
    invoices = access.query_partition(customers, "CUSTOMER#4", prefix="INVOICE#")
    assert invoices.count() == tables["Invoice"].filter("CustomerId = 4").count() == history.count() - 1
    assert access.where(music, EntityType="Track", GenreId=1).count() == 3503
    login = access.query_index(customers, INDEX1, "mail 9").collect()
    assert [r["PK"] for r in login] == ["CUSTOMER#9"]


def test_index_layout_splits_a_hot_key(spark):
    tables = generated(spark, Artist=4000)
    music = build(["music_catalog"], {**tables})["music_catalog"]
    laid_out = access.index_layout(music, INDEX1, partitions=4)
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_scan(spark):
    music = build(["music_catalog"], generated(spark, Artist=30))["music_catalog"]
    assert access.scan(music).count() == 30
    assert [r["PK"] for r in access.scan(music, limit=2).collect()] == ["ARTIST#1", "ARTIST#10"]


def test_one_stamp_serves_a_run(spark):
    before = now_stamp()
    items = build_all(generated(spark, **SAMPLE))
    stamps = {tuple(r) for df in items.values() for r in df.select("CreatedAt", "UpdatedAt").distinct().collect()}
    assert len({x for pair in stamps for x in pair}) <= len(items) and all(a == b for a, b in stamps)
    assert all(before <= a <= now_stamp() for a, _ in stamps)
    given = build_all(generated(spark, **SAMPLE), "2020-02-02T00:00:00")["employee_data"]
    assert {r["CreatedAt"] for r in given.collect()} == {"2020-02-02T00:00:00"}
