"""The collections and their entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from keyweave.operators.access import count_by_entity
from keyweave.plans.build import build
from keyweave.plans.catalog import album_items as albums
from keyweave.plans.catalog import artist_items as artists
from keyweave.plans.catalog import music_catalog as music
from keyweave.plans.catalog import track_items as tracks
from keyweave.plans.customer import customer_data as customers
from keyweave.plans.customer import customer_items as profiles
from keyweave.plans.customer import invoice_items as invoices
from keyweave.plans.employee import employee_data as employees
from keyweave.plans.playlist import playlist_data as playlists
from keyweave.plans.playlist import playlist_items as playlist_heads
from keyweave.plans.playlist import playlist_track_items as playlist_tracks
from keyweave.workload.adapter import STAMP, sql, store_tables
from keyweave.workload.primitives import line_cents
from keyweave.workload.registry import query

KEYS = ("PK", "SK", "EntityType")
INDEX = ("GSI1PK", "GSI1SK", "GSI2PK", "GSI2SK")
ARTIST = (*KEYS, "ArtistId", "Name", *INDEX)
ALBUM = (*KEYS, "AlbumId", "Title", "ArtistId", "ArtistName", *INDEX)
TRACK = (
    *KEYS, "TrackId", "Name", "Composer", "Milliseconds", "Bytes", "UnitPrice", "MediaTypeId", "MediaTypeName",
    "AlbumId", "AlbumTitle", "ArtistId", "ArtistName", "GenreId", "GenreName", *INDEX,
)
PROFILE = (*KEYS, "CustomerId", "FirstName", "LastName", "Company", "Email", "SupportRepId", "SupportRepName", *INDEX)
INVOICE = (*KEYS, "InvoiceId", "CustomerId", "InvoiceDate", "Total", "LineCount", "LineCents")
PLAYLIST = (*KEYS, "PlaylistId", "Name")
PLAYLIST_TRACK = (*KEYS, "PlaylistId", "TrackId", "TrackName", "ArtistName", "AlbumTitle", "TrackDuration", "UnitPrice")
EMPLOYEE = (*KEYS, "EmployeeId", "FirstName", "LastName", "ReportsTo", "ManagerName", "GSI1PK", "GSI1SK")


def _merged(*groups):
    """All columns of the groups, each once, in order of first use."""
    return tuple(dict.fromkeys(c for g in groups for c in g))


def _union_sql(**views):
    everything = _merged(*views.values())
    return sql(
        " UNION ALL ".join(
            f"SELECT {', '.join(c if c in columns else f'NULL AS {c}' for c in everything)} FROM {view}"
            for view, columns in views.items()
        )
    )


def _one(name, build_items, view, columns):
    @query(name, sql(f"SELECT {', '.join(columns)} FROM {view}"))
    def run(spark, sf_dir):
        return _flat(build_items(store_tables(spark, sf_dir), STAMP)).select(*columns)


def _flat(items):
    """Line lists as their sum, since results hold no nested values."""
    if "InvoiceLines" not in items.columns:
        return items
    cents = F.when(F.col("InvoiceLines").isNotNull(), line_cents("InvoiceLines"))
    return items.withColumn("LineCents", cents).drop("InvoiceLines")


_one("artist_items", artists, "i_artist", ARTIST)
_one("album_items", albums, "i_album", ALBUM)
_one("track_items", tracks, "i_track", TRACK)
_one("customer_items", profiles, "i_customer", PROFILE)
_one("invoice_items", invoices, "i_invoice", INVOICE)
_one("playlist_items", playlist_heads, "i_playlist", PLAYLIST)
_one("playlist_track_items", playlist_tracks, "i_playlisttrack", PLAYLIST_TRACK)
_one("employee_data", employees, "i_employee", EMPLOYEE)


@query("music_catalog", _union_sql(i_track=TRACK, i_album=ALBUM, i_artist=ARTIST))
def music_catalog(spark, sf_dir):
    return music(store_tables(spark, sf_dir), STAMP).select(*_merged(TRACK, ALBUM, ARTIST))


@query("customer_data", _union_sql(i_customer=PROFILE, i_invoice=INVOICE))
def customer_data(spark, sf_dir):
    return _flat(customers(store_tables(spark, sf_dir), STAMP)).select(*_merged(PROFILE, INVOICE))


@query("playlist_data", _union_sql(i_playlisttrack=PLAYLIST_TRACK, i_playlist=PLAYLIST))
def playlist_data(spark, sf_dir):
    return playlists(store_tables(spark, sf_dir), STAMP).select(*_merged(PLAYLIST_TRACK, PLAYLIST))


@query(
    "selective_build",
    sql(
        """SELECT 'customer_data' AS collection, EntityType, count(*) AS item_count FROM i_customer GROUP BY EntityType
        UNION ALL SELECT 'customer_data', EntityType, count(*) FROM i_invoice GROUP BY EntityType
        UNION ALL SELECT 'employee_data', EntityType, count(*) FROM i_employee GROUP BY EntityType"""
    ),
)
def selective_build(spark, sf_dir):
    built = build(["customer_data", "employee_data"], store_tables(spark, sf_dir), STAMP)
    return reduce(
        lambda a, b: a.unionByName(b),
        [count_by_entity(df).select(F.lit(n).alias("collection"), "EntityType", "item_count") for n, df in built.items()],
    )
