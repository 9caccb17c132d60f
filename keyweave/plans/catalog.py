"""Music catalogue: artists, albums with their artist, tracks with album, artist, genre and media type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.functions import composite_key, index_key, number, search_key, with_defaults
from keyweave.operators.joins import lookup, or_default, when_matched
from keyweave.operators.union import union_entities
from keyweave.plans.items import item, same
from keyweave.plans.store import NO_ALBUM, TEXT, UNKNOWN, UNKNOWN_ARTIST


def _metadata():
    return F.lit("METADATA")


def artist_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    artist = with_defaults(tables["Artist"], {"Name": TEXT})
    return item(
        artist,
        "Artist",
        composite_key("ARTIST", "ArtistId"),
        _metadata(),
        same("ArtistId", "Name"),
        stamp,
        index1=(F.lit("ARTIST"), index_key("Name")),
        index2=(search_key("Name"), composite_key("ARTIST", "ArtistId")),
    )


def albums_with_artist(tables: dict[str, DataFrame]) -> DataFrame:
    """Albums and the name of their artist (id 0 is an ordinary id here)."""
    album = with_defaults(tables["Album"], {"Title": TEXT})
    artist = with_defaults(tables["Artist"], {"Name": ("string", UNKNOWN_ARTIST)})
    found = lookup(album, artist, "ArtistId", "ArtistId", {"__artist": "Name"}, "__has_artist")
    named = found.withColumn("ArtistName", or_default("__has_artist", "__artist", UNKNOWN_ARTIST))
    return named.select("AlbumId", "Title", "ArtistId", "ArtistName")


def album_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    return item(
        albums_with_artist(tables),
        "Album",
        composite_key("ALBUM", "AlbumId"),
        _metadata(),
        same("AlbumId", "Title", "ArtistId", "ArtistName"),
        stamp,
        index1=(composite_key("ARTIST", "ArtistId"), index_key("Title", "ALBUM")),
        index2=(search_key("Title"), composite_key("ALBUM", "AlbumId")),
    )


def with_album(rows: DataFrame, tables: dict[str, DataFrame], link: str = "AlbumId") -> DataFrame:
    """Add album title, artist id and artist name through an optional album link."""
    return lookup(
        rows,
        albums_with_artist(tables),
        link,
        "AlbumId",
        {"__album_title": "Title", "__album_artist": "ArtistId", "__artist_name": "ArtistName"},
        "__has_album",
        optional=True,
        rows_of=tables["Album"],
    )


def track_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    track = with_defaults(
        tables["Track"],
        {
            "Name": TEXT,
            "AlbumId": ("bigint", None),
            "GenreId": ("bigint", None),
            "Composer": TEXT,
            "Milliseconds": ("bigint", 0),
            "Bytes": ("bigint", 0),
            "UnitPrice": ("double", 0.0),
        },
    )
    genre = with_defaults(tables["Genre"], {"Name": ("string", UNKNOWN)}) if "Genre" in tables else None
    media = with_defaults(tables["MediaType"], {"Name": ("string", UNKNOWN)}) if "MediaType" in tables else None
    rows = with_album(track, tables)
    rows = _named(rows, genre, "GenreId", "__genre", True, track)
    rows = _named(rows, media, "MediaTypeId", "__media", False, track)
    has_album = F.col("__has_album")
    attributes = {
        **same("TrackId", "Name", "Composer", "Milliseconds", "Bytes"),
        "UnitPrice": number("UnitPrice"),
        "MediaTypeId": F.col("MediaTypeId"),
        "MediaTypeName": or_default("__media_found", "__media", UNKNOWN),
        "AlbumId": when_matched("__has_album", "AlbumId"),
        "AlbumTitle": when_matched("__has_album", "__album_title"),
        "ArtistId": when_matched("__has_album", "__album_artist"),
        "ArtistName": or_default("__has_album", "__artist_name", UNKNOWN_ARTIST),
        "GenreId": when_matched("__genre_found", "GenreId"),
        "GenreName": when_matched("__genre_found", "__genre"),
    }
    return item(
        rows,
        "Track",
        composite_key("TRACK", "TrackId"),
        _metadata(),
        attributes,
        stamp,
        index1=(
            F.when(has_album, composite_key("ALBUM", "AlbumId")).otherwise(F.lit(NO_ALBUM)),
            index_key("Name", "TRACK"),
        ),
        index2=(search_key("Name"), composite_key("TRACK", "TrackId")),
    )


def _named(
    rows: DataFrame, dimension: DataFrame | None, link: str, into: str, optional: bool, links_in: DataFrame
) -> DataFrame:
    """Name of a small classification; a store without that table has no match at all."""
    if dimension is None:
        return rows.withColumns({into: F.lit(None).cast("string"), f"{into}_found": F.lit(False)})
    return lookup(rows, dimension, link, link, {into: "Name"}, f"{into}_found", optional=optional, links_in=links_in)


def music_catalog(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    return union_entities(
        [artist_items(tables, stamp), album_items(tables, stamp), track_items(tables, stamp)]
    )
