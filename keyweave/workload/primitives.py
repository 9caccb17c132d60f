"""Denormalisation primitives, each on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyweave.functions import (
    attribute_count,
    composite_key,
    drop_empty,
    full_name,
    index_key,
    number,
    search_key,
    try_number,
    with_defaults,
)
from keyweave.functions.codec import decode_attribute, decode_items, encode_items
from keyweave.functions.variant import attribute, attribute_names, merged, to_variant, wire, wire_attribute
from keyweave.operators.embed import embed, flatten_children
from keyweave.operators.joins import lookup, or_default
from keyweave.operators.reconcile import transform_summary as summarise
from keyweave.operators.union import union_entities
from keyweave.plans.catalog import track_items, with_album
from keyweave.plans.customer import customer_items, invoice_items
from keyweave.plans.employee import employee_data
from keyweave.plans.playlist import playlist_items, playlist_track_items, store_bridge, stored_playlist_track_items
from keyweave.plans.store import COLLECTIONS, UNKNOWN, UNKNOWN_ARTIST
from keyweave.session import scratch_path
from keyweave.workload.adapter import STAMP, counts_sql, sql, store_tables
from keyweave.workload.registry import query


@query("composite_keys", sql("SELECT 'CUSTOMER#' || CustomerId AS PK, 'INVOICE#' || InvoiceId AS SK, InvoiceId FROM t_invoice"))
def composite_keys(spark, sf_dir):
    invoice = store_tables(spark, sf_dir)["Invoice"]
    return invoice.select(
        composite_key("CUSTOMER", "CustomerId").alias("PK"), composite_key("INVOICE", "InvoiceId").alias("SK"), "InvoiceId"
    )


@query(
    "search_keys",
    sql(
        """SELECT 'TRACK#' || TrackId AS PK, 'SEARCH#' || upper(Name) AS GSI2PK, 'TRACK#' || upper(Name) AS GSI1SK FROM t_track
        UNION ALL SELECT 'CUSTOMER#' || CustomerId, lower(Email), 'CUSTOMER#' || CustomerId FROM t_customer"""
    ),
)
def search_keys(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    tracks = tables["Track"].select(
        composite_key("TRACK", "TrackId").alias("PK"), search_key("Name").alias("GSI2PK"), index_key("Name", "TRACK").alias("GSI1SK")
    )
    this = composite_key("CUSTOMER", "CustomerId")
    return tracks.unionByName(
        tables["Customer"].select(this.alias("PK"), F.lower("Email").alias("GSI2PK"), this.alias("GSI1SK"))
    )


@query(
    "default_missing_columns",
    sql("SELECT TrackId, Name, '' AS Composer, CAST(0 AS BIGINT) AS Milliseconds, AlbumId FROM t_track"),
)
def default_missing_columns(spark, sf_dir):
    """Composer and Milliseconds are missing columns; AlbumId exists, so its NULLs stay."""
    track = store_tables(spark, sf_dir)["Track"]
    filled = with_defaults(track, {"Composer": ("string", ""), "Milliseconds": ("bigint", 0), "AlbumId": ("bigint", -1)})
    return filled.select("TrackId", "Name", "Composer", "Milliseconds", "AlbumId")


# Profile: 12 always + 4 with a representative. Address parts that the source lacks are empty text.
_PROFILE_ATTRIBUTES = 15 + 4
_INVOICE_ATTRIBUTES = 15


@query(
    "sparse_attributes",
    sql(
        f"""SELECT PK, SK, CAST({_PROFILE_ATTRIBUTES} + CASE WHEN SupportRepId IS NULL THEN 0 ELSE 4 END AS BIGINT) AS attributes
        FROM i_customer
        UNION ALL SELECT PK, SK, CAST({_INVOICE_ATTRIBUTES} + CASE WHEN LineCount = 0 THEN 0 ELSE 1 END AS BIGINT) FROM i_invoice"""
    ),
)
def sparse_attributes(spark, sf_dir):
    """Attributes present per item: an unlinked representative and an empty line list are absent."""
    tables = store_tables(spark, sf_dir)
    items = drop_empty(union_entities([customer_items(tables, STAMP), invoice_items(tables, STAMP)]))
    return items.select("PK", "SK", attribute_count(items.columns).alias("attributes"))


@query(
    "numeric_coercion",
    sql(
        """SELECT c_custkey AS CustomerId, CAST(substr(c_name, 10) AS DOUBLE) AS from_text,
        CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS balance,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS DOUBLE) END AS checked FROM customer"""
    ),
)
def numeric_coercion(spark, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("c_custkey")
    return customer.select(
        key.alias("CustomerId"),
        number(F.substring("c_name", 10, 20)).alias("from_text"),
        number(F.when(key % 3 != 0, F.col("c_acctbal"))).alias("balance"),
        try_number(F.when(key % 5 == 0, F.lit("no number")).otherwise(key.cast("string"))).alias("checked"),
    )


@query("lookup_join", sql("SELECT TrackId, MediaTypeId, MediaTypeName FROM i_track"))
def lookup_join(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    found = lookup(tables["Track"], tables["MediaType"], "MediaTypeId", "MediaTypeId", {"__name": "Name"}, "__found")
    return found.select("TrackId", "MediaTypeId", or_default("__found", "__name", UNKNOWN).alias("MediaTypeName"))


@query("chained_lookup", sql("SELECT TrackId, AlbumTitle, ArtistId, ArtistName FROM i_track"))
def chained_lookup(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    found = with_album(tables["Track"], tables)
    return found.select(
        "TrackId",
        F.col("__album_title").alias("AlbumTitle"),
        F.col("__album_artist").alias("ArtistId"),
        or_default("__has_album", "__artist_name", UNKNOWN_ARTIST).alias("ArtistName"),
    )


@query("optional_block", sql("SELECT CustomerId, SupportRepId, SupportRepName, GSI2PK, GSI2SK FROM i_customer"))
def optional_block(spark, sf_dir):
    items = customer_items(store_tables(spark, sf_dir), STAMP)
    return items.select("CustomerId", "SupportRepId", "SupportRepName", "GSI2PK", "GSI2SK")


_FIELDS = ("InvoiceLineId", "TrackId", "UnitPrice", "Quantity", "LineTotal")
_ORDERED = """SELECT i.InvoiceId AS InvoiceId, InvoiceLineId, TrackId, UnitPrice, Quantity, UnitPrice * Quantity AS LineTotal,
    row_number() OVER (PARTITION BY i.InvoiceId ORDER BY InvoiceLineId, TrackId, UnitPrice, Quantity) - 1 AS place,
    count(*) OVER (PARTITION BY i.InvoiceId) AS LineCount
    FROM t_invoice i JOIN t_invoiceline l ON i.InvoiceId = l.InvoiceId"""
_LIST = ", ".join(_FIELDS)


def _embedded(spark, sf_dir, page_size):
    tables = store_tables(spark, sf_dir)
    fields = {c: F.col(c) for c in _FIELDS[:-1]}
    fields["LineTotal"] = F.col("UnitPrice") * F.col("Quantity")
    return embed(
        tables["Invoice"], "InvoiceId", tables["InvoiceLine"], "InvoiceId", fields, "InvoiceLines", "LineCount",
        page="page", page_size=page_size,
    )


@query(
    "embed_children",
    sql(f"SELECT InvoiceId, LineCount, CAST(place AS BIGINT) AS ordinal, {_LIST} FROM o", o=_ORDERED),
)
def embed_children(spark, sf_dir):
    lists = _embedded(spark, sf_dir, 10_000)
    return flatten_children(lists, "InvoiceLines", ["InvoiceId", "LineCount"], page="page", page_size=10_000).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query(
    "embed_children_paged",
    sql(
        f"""SELECT InvoiceId, LineCount, CAST(place // 3 AS BIGINT) AS page, CAST(place % 3 AS BIGINT) AS ordinal, {_LIST} FROM o""",
        o=_ORDERED,
    ),
)
def embed_children_paged(spark, sf_dir):
    """Lists cut into pages of three: the way of parents with too many children, on all rows."""
    lists = _embedded(spark, sf_dir, 3)
    return flatten_children(lists, "InvoiceLines", ["InvoiceId", "LineCount", "page"]).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query(
    "line_totals",
    sql("SELECT InvoiceId, InvoiceLineId, TrackId, UnitPrice * Quantity AS LineTotal FROM t_invoiceline"),
)
def line_totals(spark, sf_dir):
    lines = store_tables(spark, sf_dir)["InvoiceLine"]
    return lines.select("InvoiceId", "InvoiceLineId", "TrackId", (number("UnitPrice") * F.col("Quantity")).alias("LineTotal"))


@query("self_join_manager", sql("SELECT EmployeeId, ReportsTo, ManagerName, GSI1PK, GSI1SK FROM i_employee"))
def self_join_manager(spark, sf_dir):
    return employee_data(store_tables(spark, sf_dir), STAMP).select("EmployeeId", "ReportsTo", "ManagerName", "GSI1PK", "GSI1SK")


@query("bridge_enrich", sql("SELECT PlaylistId, TrackId, TrackName, ArtistName, AlbumTitle, UnitPrice FROM i_playlisttrack"))
def bridge_enrich(spark, sf_dir):
    return playlist_track_items(store_tables(spark, sf_dir), STAMP).select(
        "PlaylistId", "TrackId", "TrackName", "ArtistName", "AlbumTitle", "UnitPrice"
    )


@query(
    "stored_bridge",
    sql("SELECT PK, SK, PlaylistId, TrackId, TrackName, ArtistName, AlbumTitle, UnitPrice FROM i_playlisttrack"),
)
def stored_bridge(spark, sf_dir):
    """The same from a bridge that is stored beside its tracks: the join reads bucket by bucket."""
    pair = store_bridge(spark, store_tables(spark, sf_dir))
    return stored_playlist_track_items(pair, STAMP).select(
        "PK", "SK", "PlaylistId", "TrackId", "TrackName", "ArtistName", "AlbumTitle", "UnitPrice"
    )


@query(
    "full_name",
    """SELECT c_custkey AS CustomerId,
    trim(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '  ' || split_part(c_name, '#', 1) END || ' ' ||
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE split_part(c_name, '#', 2) || ' ' END) AS FullName FROM customer""",
)
def full_name_query(spark, sf_dir):
    """Missing first or last names and stray blanks."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("c_custkey")
    first = F.when(key % 3 != 0, F.concat(F.lit("  "), F.split_part("c_name", F.lit("#"), F.lit(1))))
    last = F.when(key % 4 != 0, F.concat(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit(" ")))
    return customer.select(key.alias("CustomerId"), full_name(first, last).alias("FullName"))


@query(
    "entity_union",
    sql(
        """SELECT PK, SK, EntityType, Name, NULL AS FirstName, PlaylistId, NULL AS EmployeeId FROM i_playlist
        UNION ALL SELECT PK, SK, EntityType, NULL, FirstName, NULL, EmployeeId FROM i_employee"""
    ),
)
def entity_union(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    both = union_entities([playlist_items(tables, STAMP), employee_data(tables, STAMP)])
    return both.select("PK", "SK", "EntityType", "Name", "FirstName", "PlaylistId", "EmployeeId")


_TARGETS = "CASE " + " ".join(
    f"WHEN table_name IN ({', '.join(repr(t) for t in s.counted)}) THEN '{s.label}'" for s in COLLECTIONS.values()
) + " END"


@query(
    "transform_summary",
    sql(
        f"""SELECT side, name, records, NULL::DOUBLE AS percent FROM l
        UNION ALL SELECT side, 'TOTAL', CAST(sum(records) AS BIGINT), NULL FROM l GROUP BY side
        UNION ALL SELECT 'efficiency', 'TOTAL', NULL,
        CAST(sum(CASE WHEN side = 'target' THEN records END) AS DOUBLE)
        / CAST(sum(CASE WHEN side = 'source' THEN records END) AS DOUBLE) * CAST(100 AS DOUBLE) FROM l""",
        c=counts_sql(),
        l=f"""SELECT 'source' AS side, table_name AS name, record_count AS records FROM c
        UNION ALL SELECT 'target', {_TARGETS}, CAST(sum(record_count) AS BIGINT) FROM c WHERE {_TARGETS} IS NOT NULL GROUP BY 1, 2""",
    ),
)
def transform_summary(spark, sf_dir):
    return summarise(COLLECTIONS, store_tables(spark, sf_dir))


@query(
    "encode_items",
    sql("SELECT PK, Name, CAST(TrackId AS DOUBLE) AS TrackId, UnitPrice, AlbumTitle, AlbumId IS NOT NULL AS has_album FROM i_track"),
)
def encode(spark, sf_dir):
    """Tracks as typed JSON; single attributes are read from the text. Absent ones are not in it."""
    encoded = encode_items(track_items(store_tables(spark, sf_dir), STAMP))
    return encoded.select(
        decode_attribute("item", "PK", "S").alias("PK"),
        decode_attribute("item", "Name", "S").alias("Name"),
        decode_attribute("item", "TrackId", "N").alias("TrackId"),
        decode_attribute("item", "UnitPrice", "N").alias("UnitPrice"),
        decode_attribute("item", "AlbumTitle", "S").alias("AlbumTitle"),
        F.get_json_object("item", "$.AlbumId").isNotNull().alias("has_album"),
    )


@query(
    "decode_items",
    sql(
        """SELECT PK, SK, InvoiceDate, Total, CAST(LineCount AS DOUBLE) AS LineCount, CAST(LineCount AS BIGINT) AS lines,
        LineCents AS line_cents FROM i_invoice"""
    ),
)
def decode(spark, sf_dir):
    """Invoices with their line lists, encoded and decoded again."""
    items = invoice_items(store_tables(spark, sf_dir), STAMP)
    columns = ("PK", "SK", "InvoiceDate", "Total", "LineCount", "InvoiceLines")
    decoded = decode_items(encode_items(items), items.select(*columns).schema, number="double")
    return decoded.select(
        "PK", "SK", "InvoiceDate", "Total", "LineCount", F.coalesce(F.size("InvoiceLines"), F.lit(0)).cast("bigint").alias("lines"),
        line_cents("InvoiceLines").alias("line_cents"),
    )


def line_cents(lines):
    """Sum of the line totals in whole cents, so that the order of the sum does not matter."""
    cents = F.transform(lines, lambda line: F.round(line["LineTotal"] * 100).cast("bigint"))
    total = F.aggregate(cents, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.coalesce(total, F.lit(0).cast("bigint"))


_EXACT = "CAST(9007199254740993 AS BIGINT)"


@query(
    "decode_exact",
    sql(
        f"""SELECT 'INVOICE#' || o_orderkey AS PK, o_orderkey + {_EXACT} AS big_id, o_orderpriority = '1-URGENT' AS urgent, n AS lines,
        big AS line_ids, cents, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS even, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS odd,
        CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + {_EXACT} END AS nested_id
        FROM orders JOIN l ON l_orderkey = o_orderkey""",
        l=f"""SELECT l_orderkey, count(*) AS n, CAST(sum(l_partkey + {_EXACT}) AS VARCHAR) AS big,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY l_orderkey""",
    ),
)
def decode_exact(spark, sf_dir):
    """Items with long ids, a flag, a list of maps, a map and a nested map: typed text, then VARIANT, read path by path."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    beyond = F.lit(9007199254740993)
    items = (
        embed(
            orders.withColumn("key", F.col("o_orderkey")), "key", lines, "l_orderkey",
            {"Id": F.col("l_partkey") + beyond, "Price": F.col("l_extendedprice")}, into="Lines", count="LineCount",
        )
        .filter("LineCount > 0")
        .select(
            composite_key("INVOICE", "key").alias("PK"),
            (F.col("key") + beyond).alias("BigId"),
            (F.col("o_orderpriority") == "1-URGENT").alias("Urgent"),
            "Lines",
            F.create_map(F.when(F.col("key") % 2 == 0, "even").otherwise("odd"), "o_orderstatus").alias("Parity"),
            F.when(F.col("key") % 3 == 0, F.struct((F.col("o_custkey") + beyond).alias("Id"), F.lit("x").alias("Kind"))).alias("Customer"),
        )
    )
    schema = items.schema
    read = encode_items(items).select(wire("item").alias("item")).select(
        *[wire_attribute(F.col("item"), [c], schema[c].dataType).alias(c) for c in ("PK", "BigId", "Urgent", "Lines", "Parity")],
        wire_attribute(F.col("item"), ["Customer", "Id"], schema["BigId"].dataType).alias("nested_id"),
    )
    exact = F.aggregate(F.transform("Lines", lambda x: x["Id"].cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"))
    cents = F.aggregate(F.transform("Lines", lambda x: F.round(x["Price"] * 100).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return read.select(
        "PK", F.col("BigId").alias("big_id"), F.col("Urgent").alias("urgent"), F.size("Lines").cast("bigint").alias("lines"),
        exact.cast("string").alias("line_ids"), cents.alias("cents"), F.col("Parity")["even"].alias("even"), F.col("Parity")["odd"].alias("odd"),
        "nested_id",
    )


@query(
    "sparse_variant",
    sql(
        """SELECT PK, SK, AlbumId, GenreName, UnitPrice, Name || CASE WHEN AlbumId IS NULL THEN '?' ELSE '' END AS Name,
        6 + CASE WHEN AlbumTitle IS NULL THEN 0 ELSE 2 END + CASE WHEN GenreName IS NULL THEN 0 ELSE 1 END
        + CASE WHEN AlbumId IS NULL THEN 1 ELSE 0 END AS attributes FROM i_track"""
    ),
)
def sparse_variant(spark, sf_dir):
    """Tracks stored as VARIANT with what they have; changed, stored again, and read by single paths."""
    tracks = track_items(store_tables(spark, sf_dir), STAMP).select(
        "PK", "SK", "TrackId", "Name", "UnitPrice", "MediaTypeId", "MediaTypeName", "ArtistName", "AlbumId", "AlbumTitle", "GenreName"
    )
    path = scratch_path(spark, "variants")
    to_variant(tracks).write.parquet(path)
    stored = spark.read.parquet(path)
    # Tracks without an album get a mark and another name.
    change = F.to_json(F.struct(F.concat(attribute("item", "Name", "string"), F.lit("?")).alias("Name"), F.lit(True).alias("Single")))
    single = attribute("item", "AlbumId", "bigint").isNull()
    changed = stored.withColumn("item", F.when(single, merged("item", F.parse_json(change))).otherwise(F.col("item")))
    return changed.select(
        "PK",
        "SK",
        attribute("item", "AlbumId", "bigint").alias("AlbumId"),
        attribute("item", "GenreName", "string").alias("GenreName"),
        attribute("item", "UnitPrice", "double").alias("UnitPrice"),
        attribute("item", "Name", "string").alias("Name"),
        F.size(attribute_names("item")).cast("bigint").alias("attributes"),
    )
