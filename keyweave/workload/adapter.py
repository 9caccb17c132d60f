"""The benchmark tables in the shape of the relational store, in Spark and as SQL for the checks.

Links are shifted by modulo so that all cases occur: no link, link to nothing, and a match. Each
adapted table keeps all rows of the table it is made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.sources.tables import TableSet, read_tables

STAMP = "2024-01-01T00:00:00"

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def store_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    raw = read_tables(spark, sf_dir, RAW)
    brand = "CAST(substr(p_brand, 7) AS BIGINT)"

    def customers() -> DataFrame:
        slots = raw["supplier"].select((F.count(F.lit(1)) + 2).alias("n")).scalar()
        return raw["customer"].select(
            F.col("c_custkey").alias("CustomerId"),
            F.expr("split_part(c_name, '#', 1)").alias("FirstName"),
            F.expr("split_part(c_name, '#', 2)").alias("LastName"),
            F.col("c_mktsegment").alias("Company"),
            F.concat(F.lower("c_name"), F.lit("@x.io")).alias("Email"),
            (F.col("c_custkey") % slots).alias("SupportRepId"),
        )

    return TableSet(
        {
            "Artist": lambda: raw["region"].selectExpr("CAST(r_regionkey AS BIGINT) AS ArtistId", "r_name AS Name"),
            "Album": lambda: raw["nation"].selectExpr(
                "CAST(n_nationkey AS BIGINT) AS AlbumId", "n_name AS Title", "CAST(n_regionkey AS BIGINT) AS ArtistId"
            ),
            # Genres of brands above 20 have other ids, so the tracks of these brands miss the lookup.
            "Genre": lambda: raw["part"]
            .selectExpr(f"CASE WHEN {brand} > 20 THEN {brand} + 100 ELSE {brand} END AS GenreId", "p_brand AS Name")
            .distinct(),
            "MediaType": lambda: raw["region"].selectExpr(
                "CAST(r_regionkey AS BIGINT) AS MediaTypeId", "r_name AS Name"
            ),
            "Track": lambda: raw["part"].selectExpr(
                "p_partkey AS TrackId",
                "p_name AS Name",
                "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 28 END AS AlbumId",
                f"{brand} AS GenreId",
                "CAST(p_size % 6 AS BIGINT) AS MediaTypeId",
                "p_retailprice AS UnitPrice",
            ),
            "Employee": lambda: raw["supplier"].selectExpr(
                "s_suppkey AS EmployeeId",
                "split_part(s_name, '#', 1) AS FirstName",
                "split_part(s_name, '#', 2) AS LastName",
                "s_suppkey div 10 AS ReportsTo",
            ),
            "Customer": customers,
            "Invoice": lambda: raw["orders"].selectExpr(
                "o_orderkey AS InvoiceId",
                "o_custkey AS CustomerId",
                "date_format(o_orderdate, 'yyyy-MM-dd') AS InvoiceDate",
                "o_totalprice AS Total",
            ),
            "InvoiceLine": lambda: raw["lineitem"].selectExpr(
                "CAST(l_linenumber AS BIGINT) AS InvoiceLineId",
                "l_orderkey AS InvoiceId",
                "l_partkey AS TrackId",
                "l_extendedprice / l_quantity AS UnitPrice",
                "l_quantity AS Quantity",
            ),
            "Playlist": lambda: raw["supplier"].selectExpr("s_suppkey AS PlaylistId", "s_name AS Name"),
            "PlaylistTrack": lambda: raw["lineitem"]
            .selectExpr("l_suppkey AS PlaylistId", "l_partkey AS TrackId")
            .distinct(),
        }
    )


# The same tables, and the items built from them, as SQL. Items leave out the stamps.
VIEWS = {
    "t_artist": "SELECT CAST(r_regionkey AS BIGINT) AS ArtistId, r_name AS Name FROM region",
    "t_album": "SELECT CAST(n_nationkey AS BIGINT) AS AlbumId, n_name AS Title, CAST(n_regionkey AS BIGINT) AS ArtistId FROM nation",
    "t_genre": """SELECT DISTINCT CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) > 20 THEN CAST(substr(p_brand, 7) AS BIGINT) + 100
        ELSE CAST(substr(p_brand, 7) AS BIGINT) END AS GenreId, p_brand AS Name FROM part""",
    "t_mediatype": "SELECT CAST(r_regionkey AS BIGINT) AS MediaTypeId, r_name AS Name FROM region",
    "t_track": """SELECT p_partkey AS TrackId, p_name AS Name,
        CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 28 END AS AlbumId,
        CAST(substr(p_brand, 7) AS BIGINT) AS GenreId, CAST(p_size % 6 AS BIGINT) AS MediaTypeId,
        p_retailprice AS UnitPrice FROM part""",
    "t_employee": """SELECT s_suppkey AS EmployeeId, split_part(s_name, '#', 1) AS FirstName,
        split_part(s_name, '#', 2) AS LastName, s_suppkey // 10 AS ReportsTo FROM supplier""",
    "t_customer": """SELECT c_custkey AS CustomerId, split_part(c_name, '#', 1) AS FirstName,
        split_part(c_name, '#', 2) AS LastName, c_mktsegment AS Company, lower(c_name) || '@x.io' AS Email,
        c_custkey % (SELECT count(*) + 2 FROM supplier) AS SupportRepId FROM customer""",
    "t_invoice": """SELECT o_orderkey AS InvoiceId, o_custkey AS CustomerId,
        strftime(o_orderdate, '%Y-%m-%d') AS InvoiceDate, o_totalprice AS Total FROM orders""",
    "t_invoiceline": """SELECT CAST(l_linenumber AS BIGINT) AS InvoiceLineId, l_orderkey AS InvoiceId,
        l_partkey AS TrackId, l_extendedprice / l_quantity AS UnitPrice, l_quantity AS Quantity FROM lineitem""",
    "t_playlist": "SELECT s_suppkey AS PlaylistId, s_name AS Name FROM supplier",
    "t_playlisttrack": "SELECT DISTINCT l_suppkey AS PlaylistId, l_partkey AS TrackId FROM lineitem",
    "i_artist": """SELECT 'ARTIST#' || ArtistId AS PK, 'METADATA' AS SK, 'Artist' AS EntityType, ArtistId, Name,
        'ARTIST' AS GSI1PK, upper(Name) AS GSI1SK, 'SEARCH#' || upper(Name) AS GSI2PK, 'ARTIST#' || ArtistId AS GSI2SK
        FROM t_artist""",
    "i_album": """SELECT 'ALBUM#' || AlbumId AS PK, 'METADATA' AS SK, 'Album' AS EntityType, AlbumId, Title,
        a.ArtistId AS ArtistId, coalesce(r.Name, 'Unknown Artist') AS ArtistName,
        'ARTIST#' || a.ArtistId AS GSI1PK, 'ALBUM#' || upper(Title) AS GSI1SK,
        'SEARCH#' || upper(Title) AS GSI2PK, 'ALBUM#' || AlbumId AS GSI2SK
        FROM t_album a LEFT JOIN t_artist r ON a.ArtistId = r.ArtistId""",
    "i_track": """SELECT 'TRACK#' || t.TrackId AS PK, 'METADATA' AS SK, 'Track' AS EntityType, t.TrackId AS TrackId,
        t.Name AS Name, '' AS Composer, CAST(0 AS BIGINT) AS Milliseconds, CAST(0 AS BIGINT) AS Bytes,
        t.UnitPrice AS UnitPrice, t.MediaTypeId AS MediaTypeId, coalesce(m.Name, 'Unknown') AS MediaTypeName,
        a.AlbumId AS AlbumId, a.Title AS AlbumTitle, a.ArtistId AS ArtistId,
        coalesce(a.ArtistName, 'Unknown Artist') AS ArtistName, g.GenreId AS GenreId, g.Name AS GenreName,
        coalesce('ALBUM#' || a.AlbumId, 'NO_ALBUM') AS GSI1PK, 'TRACK#' || upper(t.Name) AS GSI1SK,
        'SEARCH#' || upper(t.Name) AS GSI2PK, 'TRACK#' || t.TrackId AS GSI2SK
        FROM t_track t LEFT JOIN i_album a ON t.AlbumId = a.AlbumId AND t.AlbumId <> 0
        LEFT JOIN t_genre g ON t.GenreId = g.GenreId AND t.GenreId <> 0
        LEFT JOIN t_mediatype m ON t.MediaTypeId = m.MediaTypeId""",
    "i_customer": """SELECT 'CUSTOMER#' || CustomerId AS PK, 'PROFILE' AS SK, 'CustomerProfile' AS EntityType,
        CustomerId, c.FirstName AS FirstName, c.LastName AS LastName, Company, Email,
        CASE WHEN SupportRepId <> 0 THEN SupportRepId END AS SupportRepId,
        CASE WHEN SupportRepId <> 0 THEN coalesce(e.FirstName || ' ' || e.LastName, '') END AS SupportRepName,
        lower(Email) AS GSI1PK, 'CUSTOMER#' || CustomerId AS GSI1SK,
        CASE WHEN SupportRepId <> 0 THEN 'SUPPORT_REP#' || SupportRepId END AS GSI2PK,
        CASE WHEN SupportRepId <> 0 THEN 'CUSTOMER#' || CustomerId END AS GSI2SK
        FROM t_customer c LEFT JOIN t_employee e ON c.SupportRepId = e.EmployeeId AND SupportRepId <> 0""",
    "i_lines": """SELECT InvoiceId, count(*) AS LineCount,
        CAST(sum(CAST(round(UnitPrice * Quantity * 100) AS BIGINT)) AS BIGINT) AS LineCents
        FROM t_invoiceline GROUP BY InvoiceId""",
    "i_invoice": """SELECT 'CUSTOMER#' || CustomerId AS PK, 'INVOICE#' || i.InvoiceId AS SK, 'Invoice' AS EntityType,
        i.InvoiceId AS InvoiceId, CustomerId, InvoiceDate, Total, coalesce(LineCount, 0) AS LineCount,
        coalesce(LineCents, 0) AS LineCents
        FROM t_invoice i LEFT JOIN i_lines l ON i.InvoiceId = l.InvoiceId""",
    "i_playlist": """SELECT 'PLAYLIST#' || PlaylistId AS PK, 'METADATA' AS SK, 'Playlist' AS EntityType, PlaylistId, Name
        FROM t_playlist""",
    "i_playlisttrack": """SELECT 'PLAYLIST#' || p.PlaylistId AS PK, 'TRACK#' || p.TrackId AS SK,
        'PlaylistTrack' AS EntityType, p.PlaylistId AS PlaylistId, p.TrackId AS TrackId,
        CASE WHEN t.TrackId IS NULL THEN 'Unknown Track' ELSE t.Name END AS TrackName,
        coalesce(a.ArtistName, 'Unknown Artist') AS ArtistName, coalesce(a.Title, 'Unknown Album') AS AlbumTitle,
        CAST(0 AS BIGINT) AS TrackDuration, coalesce(t.UnitPrice, 0.0) AS UnitPrice
        FROM t_playlisttrack p LEFT JOIN t_track t ON p.TrackId = t.TrackId
        LEFT JOIN i_album a ON t.AlbumId = a.AlbumId AND t.AlbumId <> 0""",
    "i_employee": """SELECT 'EMPLOYEE#' || e.EmployeeId AS PK, 'PROFILE' AS SK, 'EmployeeProfile' AS EntityType,
        e.EmployeeId AS EmployeeId, e.FirstName AS FirstName, e.LastName AS LastName,
        CASE WHEN e.ReportsTo <> 0 THEN e.ReportsTo END AS ReportsTo,
        CASE WHEN e.ReportsTo <> 0 THEN coalesce(m.FirstName || ' ' || m.LastName, '') END AS ManagerName,
        CASE WHEN e.ReportsTo <> 0 THEN 'MANAGER#' || e.ReportsTo END AS GSI1PK,
        CASE WHEN e.ReportsTo <> 0 THEN 'EMPLOYEE#' || e.EmployeeId END AS GSI1SK
        FROM t_employee e LEFT JOIN t_employee m ON e.ReportsTo = m.EmployeeId AND e.ReportsTo <> 0""",
}

TABLE_VIEWS = {
    "Artist": "t_artist", "Album": "t_album", "Genre": "t_genre", "MediaType": "t_mediatype", "Track": "t_track",
    "Employee": "t_employee", "Customer": "t_customer", "Invoice": "t_invoice", "InvoiceLine": "t_invoiceline",
    "Playlist": "t_playlist", "PlaylistTrack": "t_playlisttrack",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name, body in VIEWS.items():
        if name not in found and any(token == name for token in text.replace("(", " ").replace(")", " ").replace(",", " ").split()):
            _needed(body, found)
            found[name] = None


def sql(body: str, recursive: str = "", **extra: str) -> str:
    """``body`` behind the views it uses; ``extra`` views may use the others."""
    found: dict[str, None] = {}
    for text in [*extra.values(), recursive, body]:
        _needed(text, found)
    parts = [f"{n} AS ({VIEWS[n]})" for n in found] + [f"{n} AS ({t})" for n, t in extra.items()]
    if recursive:
        parts.append(recursive)
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return head + body


def counts_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {v}" for t, v in TABLE_VIEWS.items())
