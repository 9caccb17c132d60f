"""The relational store and its four collections, as declarations.

Fixed values: table, column, entity and key names, key prefixes, and the defaults of missed lookups
are part of the results and have to stay as they are.
"""

from __future__ import annotations

from keyweave.specs import CollectionSpec, ForeignKey, IndexSpec, TableSpec

TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("Artist", ("ArtistId",)),
        TableSpec("Album", ("AlbumId",), (ForeignKey("ArtistId", "Artist", "ArtistId"),)),
        TableSpec("Genre", ("GenreId",)),
        TableSpec("MediaType", ("MediaTypeId",)),
        TableSpec(
            "Track",
            ("TrackId",),
            (
                ForeignKey("AlbumId", "Album", "AlbumId"),
                ForeignKey("GenreId", "Genre", "GenreId"),
                ForeignKey("MediaTypeId", "MediaType", "MediaTypeId"),
            ),
        ),
        TableSpec("Employee", ("EmployeeId",), (ForeignKey("ReportsTo", "Employee", "EmployeeId"),)),
        TableSpec("Customer", ("CustomerId",), (ForeignKey("SupportRepId", "Employee", "EmployeeId"),)),
        TableSpec("Invoice", ("InvoiceId",), (ForeignKey("CustomerId", "Customer", "CustomerId"),)),
        TableSpec(
            "InvoiceLine",
            ("InvoiceLineId",),
            (ForeignKey("InvoiceId", "Invoice", "InvoiceId"), ForeignKey("TrackId", "Track", "TrackId")),
        ),
        TableSpec("Playlist", ("PlaylistId",)),
        TableSpec(
            "PlaylistTrack",
            ("PlaylistId", "TrackId"),
            (ForeignKey("PlaylistId", "Playlist", "PlaylistId"), ForeignKey("TrackId", "Track", "TrackId")),
        ),
    )
}

INDEX1 = IndexSpec("GSI1", "GSI1PK", "GSI1SK")
INDEX2 = IndexSpec("GSI2", "GSI2PK", "GSI2SK")

COLLECTIONS = {
    spec.name: spec
    for spec in (
        CollectionSpec(
            name="music_catalog",
            label="MusicCatalog",
            sources=("Artist", "Album", "Track", "Genre", "MediaType"),
            entities=("Artist", "Album", "Track"),
            key_prefixes=("ARTIST#", "ALBUM#", "TRACK#"),
            required={
                "Artist": ("Name",),
                "Album": ("Title", "ArtistName"),
                "Track": ("Name", "ArtistName", "UnitPrice"),
            },
            counted=("Artist", "Album", "Track"),
            indexes=(INDEX1, INDEX2),
        ),
        CollectionSpec(
            name="customer_data",
            label="CustomerData",
            sources=("Customer", "Invoice", "InvoiceLine"),
            entities=("CustomerProfile", "Invoice"),
            key_prefixes=("CUSTOMER#",),
            required={
                "CustomerProfile": ("FirstName", "LastName", "Email"),
                "Invoice": ("InvoiceDate", "Total"),
            },
            counted=("Customer", "Invoice"),
            indexes=(INDEX1, INDEX2),
        ),
        CollectionSpec(
            name="playlist_data",
            label="PlaylistData",
            sources=("Playlist", "PlaylistTrack"),
            entities=("Playlist", "PlaylistTrack"),
            key_prefixes=("PLAYLIST#",),
            required={"Playlist": ("Name",), "PlaylistTrack": ("TrackName", "ArtistName")},
            counted=("Playlist", "PlaylistTrack"),
        ),
        CollectionSpec(
            name="employee_data",
            label="EmployeeData",
            sources=("Employee",),
            entities=("EmployeeProfile",),
            key_prefixes=("EMPLOYEE#",),
            required={"EmployeeProfile": ("FirstName", "LastName", "Title")},
            counted=("Employee",),
            indexes=(INDEX1,),
            exact_count=True,
            may_be_empty=True,
        ),
    )
}

UNKNOWN_ARTIST = "Unknown Artist"
UNKNOWN_ALBUM = "Unknown Album"
UNKNOWN_TRACK = "Unknown Track"
UNKNOWN = "Unknown"
NO_ALBUM = "NO_ALBUM"

TEXT = ("string", "")
CONTACT = ("Address", "City", "State", "Country", "PostalCode", "Phone", "Fax", "Email")
