"""Playlist data: playlists and their tracks with track, album and artist values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.functions import composite_key, number, with_defaults
from keyweave.operators.joins import lookup, or_default
from keyweave.operators.union import union_entities
from keyweave.plans.catalog import with_album
from keyweave.plans.items import item, same
from keyweave.plans.store import TEXT, UNKNOWN_ALBUM, UNKNOWN_ARTIST, UNKNOWN_TRACK
from keyweave.sources.colocated import CoLocated


def playlist_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    playlist = with_defaults(tables["Playlist"], {"Name": TEXT})
    return item(
        playlist,
        "Playlist",
        composite_key("PLAYLIST", "PlaylistId"),
        F.lit("METADATA"),
        same("PlaylistId", "Name"),
        stamp,
    )


def full_tracks(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Tracks with album and artist, and the plain tracks they are made from."""
    track = with_defaults(
        tables["Track"],
        {
            "Name": ("string", UNKNOWN_TRACK),
            "AlbumId": ("bigint", None),
            "Milliseconds": ("bigint", 0),
            "UnitPrice": ("double", 0.0),
        },
    ).select("TrackId", "Name", "AlbumId", "Milliseconds", "UnitPrice")
    full = with_album(track, tables).select(
        F.col("TrackId").alias("__track"),
        "Name",
        or_default("__has_album", "__artist_name", UNKNOWN_ARTIST).alias("ArtistName"),
        or_default("__has_album", "__album_title", UNKNOWN_ALBUM).alias("AlbumTitle"),
        "Milliseconds",
        number("UnitPrice").alias("UnitPrice"),
    )
    return full, track


_TAKE = {f"__{c}": c for c in ("Name", "ArtistName", "AlbumTitle", "Milliseconds", "UnitPrice")}


def playlist_track_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    """The tracks are completed with album and artist first, so the big bridge is joined only once."""
    full, track = full_tracks(tables)
    bridge = tables["PlaylistTrack"].select("PlaylistId", "TrackId")
    return _bridge_items(lookup(bridge, full, "TrackId", "__track", _TAKE, "__found", rows_of=track), stamp)


def store_bridge(spark: SparkSession, tables: dict[str, DataFrame], buckets: int | None = None, root: str | None = None) -> CoLocated:
    """The bridge and the completed tracks, stored so that their join needs no exchange."""
    full, _ = full_tracks(tables)
    pair = CoLocated(spark, root)
    pair.write(tables["PlaylistTrack"].select("PlaylistId", "TrackId"), "TrackId", full, "__track", buckets)
    return pair


def stored_playlist_track_items(pair: CoLocated, stamp: str) -> DataFrame:
    """``playlist_track_items`` from a stored bridge."""
    return _bridge_items(pair.joined(_TAKE, "__found"), stamp)


def _bridge_items(rows: DataFrame, stamp: str) -> DataFrame:
    return item(
        rows,
        "PlaylistTrack",
        composite_key("PLAYLIST", "PlaylistId"),
        composite_key("TRACK", "TrackId"),
        {
            **same("PlaylistId", "TrackId"),
            "TrackName": or_default("__found", "__Name", UNKNOWN_TRACK),
            "ArtistName": or_default("__found", "__ArtistName", UNKNOWN_ARTIST),
            "AlbumTitle": or_default("__found", "__AlbumTitle", UNKNOWN_ALBUM),
            "TrackDuration": or_default("__found", "__Milliseconds", 0),
            "UnitPrice": or_default("__found", "__UnitPrice", 0.0),
        },
        stamp,
    )


def playlist_data(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    return union_entities([playlist_items(tables, stamp), playlist_track_items(tables, stamp)])
