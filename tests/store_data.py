"""Stores for the tests: hand-made rows and generated ones of given sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMAS = {
    "Artist": "ArtistId bigint, Name string",
    "Album": "AlbumId bigint, Title string, ArtistId bigint",
    "Genre": "GenreId bigint, Name string",
    "MediaType": "MediaTypeId bigint, Name string",
    "Track": "TrackId bigint, Name string, AlbumId bigint, GenreId bigint, MediaTypeId bigint, Composer string, "
    "Milliseconds bigint, Bytes bigint, UnitPrice double",
    "Employee": "EmployeeId bigint, FirstName string, LastName string, Title string, ReportsTo bigint",
    "Customer": "CustomerId bigint, FirstName string, LastName string, Email string, SupportRepId bigint",
    "Invoice": "InvoiceId bigint, CustomerId bigint, InvoiceDate string, Total double",
    "InvoiceLine": "InvoiceLineId bigint, InvoiceId bigint, TrackId bigint, UnitPrice double, Quantity bigint",
    "Playlist": "PlaylistId bigint, Name string",
    "PlaylistTrack": "PlaylistId bigint, TrackId bigint",
}

ROWS = {
    "Artist": [(0, "Zero"), (1, "Abba"), (2, None)],
    "Album": [(0, "Nil", 1), (1, "Gold", 1), (2, "Bare", 2), (3, "Lost", 99), (4, "Start", 0)],
    "Genre": [(1, "Pop"), (2, None)],
    "MediaType": [(0, "File"), (1, "Disc")],
    "Track": [
        (1, "One", 1, 1, 1, "A", 100, 10, 0.99),
        (2, "two", 0, 0, 0, None, None, 20, None),
        (3, None, None, None, 7, "B", 300, 30, 1.0),
        (4, "Four", 77, 66, 1, "C", 400, 40, 12345678.9),
        (5, "Five", 2, 2, 1, "D", 500, 50, 1.5),
        (6, "Six", 3, 1, 1, "E", 600, 60, 1.5),
        (7, "Seven", 4, 1, 1, "F", 700, 70, 1.5),
    ],
    "Employee": [(1, "Ann", "Lee", "Boss", None), (2, "Bob", None, "Rep", 1), (3, " Cy ", "Dee", "Rep", 0), (4, "Eve", "Fox", None, 88)],
    "Customer": [
        (1, "Gus", "Hay", "Gus@X.io", 2), (2, "Ida", "Jon", None, 0), (3, "Kim", "Lou", "", None), (4, "Max", "Ney", "m@x.io", 88),
    ],
    "Invoice": [(10, 1, "2024-01-01", 5.0), (11, 1, "2024-01-02", None), (12, 2, None, 1.0)],
    "InvoiceLine": [(3, 10, 1, 0.5, 2), (1, 10, 2, 1.5, 1), (2, 10, 3, None, 4), (4, 12, 1, 1.0, 1), (5, 99, 1, 1.0, 1)],
    "Playlist": [(1, "All"), (2, None)],
    "PlaylistTrack": [(1, 1), (1, 2), (1, 3), (2, 5), (2, 6), (2, 1000)],
}


def hand_made(spark):
    return {name: spark.createDataFrame(ROWS[name], SCHEMAS[name]) for name in SCHEMAS}


def generated(spark, **sizes):
    """A store of the given row counts, linked by the rule that row i belongs to parent (i - 1) % n + 1."""

    def ids(table, **columns):
        n = sizes.get(table, 0)
        key = table + "Id"
        df = spark.range(1, n + 1).withColumnRenamed("id", key) if n else spark.range(0).withColumnRenamed("id", key)
        return df.select(key, *[c.alias(name) for name, c in columns.items()])

    def parent(key, table):
        return F.when(F.lit(sizes.get(table, 0) > 0), (F.col(key) - 1) % max(1, sizes.get(table, 0)) + 1)

    def named(key, prefix):
        return F.concat(F.lit(prefix + " "), F.col(key).cast("string"))

    n_playlists = max(1, sizes.get("Playlist", 0))
    return {
        "Artist": ids("Artist", Name=named("ArtistId", "Artist")),
        "Album": ids("Album", Title=named("AlbumId", "Album"), ArtistId=parent("AlbumId", "Artist")),
        "Genre": ids("Genre", Name=named("GenreId", "Genre")),
        "MediaType": ids("MediaType", Name=named("MediaTypeId", "Media")),
        "Track": ids(
            "Track", Name=named("TrackId", "Track"), AlbumId=parent("TrackId", "Album"), GenreId=F.lit(1).cast("bigint"),
            MediaTypeId=F.lit(1).cast("bigint"), Milliseconds=F.lit(1).cast("bigint"), Bytes=F.lit(1).cast("bigint"), UnitPrice=F.lit(0.99),
        ),
        "Employee": ids("Employee", FirstName=F.lit("F"), LastName=F.lit("L"), Title=F.lit("T"), ReportsTo=F.lit(1).cast("bigint")),
        "Customer": ids(
            "Customer", FirstName=F.lit("F"), LastName=F.lit("L"), Email=named("CustomerId", "mail"), SupportRepId=parent("CustomerId", "Employee"),
        ),
        "Invoice": ids("Invoice", CustomerId=parent("InvoiceId", "Customer"), InvoiceDate=F.lit("2024-01-01"), Total=F.lit(1.0)),
        "InvoiceLine": ids(
            "InvoiceLine", InvoiceId=parent("InvoiceLineId", "Invoice"), TrackId=parent("InvoiceLineId", "Track"),
            UnitPrice=F.lit(0.99), Quantity=F.lit(1).cast("bigint"),
        ),
        "Playlist": ids("Playlist", Name=named("PlaylistId", "List")),
        "PlaylistTrack": spark.range(sizes.get("PlaylistTrack", 0)).select(
            (F.col("id") % n_playlists + 1).alias("PlaylistId"), (F.floor(F.col("id") / n_playlists) + 1).cast("bigint").alias("TrackId")
        ),
    }


# Row counts of the full store and of the sample.
FULL = {
    "Artist": 275, "Album": 347, "Track": 3503, "Genre": 25, "MediaType": 5, "Customer": 59, "Employee": 8,
    "Invoice": 412, "InvoiceLine": 2240, "Playlist": 18, "PlaylistTrack": 8715,
}
SAMPLE = {
    "Artist": 3, "Album": 5, "Track": 10, "Genre": 25, "MediaType": 5, "Customer": 3, "Invoice": 5, "InvoiceLine": 10,
    "Playlist": 2, "PlaylistTrack": 10, "Employee": 8,
}
