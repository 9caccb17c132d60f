"""Access patterns over whole collections: the requested keys are themselves tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from keyweave.functions import composite_key, search_key
from keyweave.operators import access
from keyweave.operators.hierarchy import depths
from keyweave.operators.joins import keyed_join
from keyweave.operators.substring import SubstringIndex
from keyweave.operators.subtree import pairs_below, subtree, subtree_labels, subtree_totals, write_labels
from keyweave.plans.build import build_all
from keyweave.plans.catalog import music_catalog, track_items
from keyweave.plans.customer import customer_data
from keyweave.plans.employee import employee_data
from keyweave.plans.store import INDEX1, INDEX2
from keyweave.operators.upsert import KEYS
from keyweave.session import scratch_path
from keyweave.sources.snapshots import Snapshots
from keyweave.workload.adapter import STAMP, sql, store_tables
from keyweave.workload.registry import query


@query(
    "get_item",
    sql("SELECT PK, Name, AlbumTitle, ArtistName, UnitPrice FROM i_track WHERE TrackId IN (SELECT TrackId FROM t_invoiceline)"),
)
def get_item(spark, sf_dir):
    """Point gets of every track that was ever sold."""
    tables = store_tables(spark, sf_dir)
    keys = tables["InvoiceLine"].select(composite_key("TRACK", "TrackId").alias("PK"), F.lit("METADATA").alias("SK"))
    found = access.get_items(music_catalog(tables, STAMP), keys)
    return found.select("PK", "Name", "AlbumTitle", "ArtistName", "UnitPrice")


_MACHINERY = "SELECT CustomerId FROM t_customer WHERE Company = 'MACHINERY'"


def _machinery(tables):
    return tables["Customer"].filter(F.col("Company") == "MACHINERY").select(composite_key("CUSTOMER", "CustomerId").alias("PK"))


@query(
    "partition_query",
    sql(
        f"""SELECT PK, SK, EntityType, Email, CAST(NULL AS DOUBLE) AS Total, NULL AS LineCount FROM i_customer WHERE CustomerId IN ({_MACHINERY})
        UNION ALL SELECT PK, SK, EntityType, NULL, Total, LineCount FROM i_invoice WHERE CustomerId IN ({_MACHINERY})"""
    ),
)
def partition_query(spark, sf_dir):
    """Profile and purchase history of all customers of one segment."""
    tables = store_tables(spark, sf_dir)
    found = access.query_partitions(customer_data(tables, STAMP), _machinery(tables))
    return found.select("PK", "SK", "EntityType", "Email", "Total", "LineCount")


@query("prefix_query", sql(f"SELECT PK, SK, InvoiceDate, Total FROM i_invoice WHERE CustomerId IN ({_MACHINERY})"))
def prefix_query(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    found = access.query_partitions(customer_data(tables, STAMP), _machinery(tables), prefix="INVOICE#")
    return found.select("PK", "SK", "InvoiceDate", "Total")


@query(
    "index1_query",
    sql(
        """SELECT 'tracks of album' AS pattern, GSI1PK, GSI1SK, PK FROM i_track WHERE AlbumId IS NOT NULL
        UNION ALL SELECT 'albums of artist', GSI1PK, GSI1SK, PK FROM i_album
        WHERE ArtistId IN (SELECT ArtistId FROM t_artist)
        UNION ALL SELECT 'login', GSI1PK, GSI1SK, PK FROM i_customer
        UNION ALL SELECT 'reports of manager', GSI1PK, GSI1SK, PK FROM i_employee
        WHERE ReportsTo IN (SELECT EmployeeId FROM t_employee)"""
    ),
)
def index1_query(spark, sf_dir):
    """Tracks of all albums, albums of all artists, logins of all e-mails, reports of all managers."""
    tables = store_tables(spark, sf_dir)
    music = music_catalog(tables, STAMP)
    people = tables["Customer"].select(F.lower("Email").alias("key"))
    requests = [
        ("tracks of album", music, tables["Album"].select(composite_key("ALBUM", "AlbumId").alias("key"))),
        ("albums of artist", music, tables["Artist"].select(composite_key("ARTIST", "ArtistId").alias("key"))),
        ("login", customer_data(tables, STAMP), people),
        ("reports of manager", employee_data(tables, STAMP), tables["Employee"].select(composite_key("MANAGER", "EmployeeId").alias("key"))),
    ]
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            access.query_index_many(items, INDEX1, keys, "key").select(F.lit(pattern).alias("pattern"), "GSI1PK", "GSI1SK", "PK")
            for pattern, items, keys in requests
        ],
    )


@query(
    "index2_query",
    sql(
        """SELECT 'name search' AS pattern, GSI2PK, GSI2SK, PK FROM i_track WHERE GSI2PK IS NOT NULL
        UNION ALL SELECT 'name search', GSI2PK, GSI2SK, PK FROM i_album WHERE GSI2PK IS NOT NULL
        UNION ALL SELECT 'name search', GSI2PK, GSI2SK, PK FROM i_artist WHERE GSI2PK IS NOT NULL
        UNION ALL SELECT 'customers of rep', GSI2PK, GSI2SK, PK FROM i_customer
        WHERE SupportRepId IN (SELECT EmployeeId FROM t_employee)"""
    ),
)
def index2_query(spark, sf_dir):
    """Exact name search for every track, album and artist name, and the customers of every representative."""
    tables = store_tables(spark, sf_dir)
    named = (("Track", "Name"), ("Album", "Title"), ("Artist", "Name"))
    names = reduce(lambda a, b: a.unionByName(b), [tables[t].select(search_key(c).alias("key")) for t, c in named])
    reps = tables["Employee"].select(composite_key("SUPPORT_REP", "EmployeeId").alias("key"))
    tracks = access.query_index_many(music_catalog(tables, STAMP), INDEX2, names, "key")
    customers = access.query_index_many(customer_data(tables, STAMP), INDEX2, reps, "key")
    columns = ("GSI2PK", "GSI2SK", "PK")
    return tracks.select(F.lit("name search").alias("pattern"), *columns).unionByName(
        customers.select(F.lit("customers of rep").alias("pattern"), *columns)
    )


@query(
    "sparse_index",
    sql(
        """SELECT GSI1PK, GSI1SK, PK, EntityType FROM i_track UNION ALL SELECT GSI1PK, GSI1SK, PK, EntityType FROM i_album
        UNION ALL SELECT GSI1PK, GSI1SK, PK, EntityType FROM i_artist
        UNION ALL SELECT GSI1PK, GSI1SK, PK, EntityType FROM i_customer WHERE GSI1PK IS NOT NULL
        UNION ALL SELECT GSI1PK, GSI1SK, PK, EntityType FROM i_employee WHERE GSI1PK IS NOT NULL"""
    ),
)
def sparse_index(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    columns = ("GSI1PK", "GSI1SK", "PK", "EntityType")
    music = access.index_layout(music_catalog(tables, STAMP).select(*columns), INDEX1)
    people = [access.index_layout(df.select(*columns), INDEX1) for df in (customer_data(tables, STAMP), employee_data(tables, STAMP))]
    return reduce(lambda a, b: a.unionByName(b), people, music)


@query("substring_search", sql("SELECT PK, Name, ArtistName FROM i_track WHERE upper(Name) LIKE '%RING%'"))
def substring_search(spark, sf_dir):
    return access.contains(track_items(store_tables(spark, sf_dir), STAMP), "Name", "ring").select("PK", "Name", "ArtistName")


@query(
    "substring_index",
    sql(
        """SELECT 'RING' AS text, PK, Name FROM i_track WHERE upper(Name) LIKE '%RING%' UNION ALL SELECT 'l r', PK, Name FROM i_track WHERE upper(Name) LIKE '%L R%'
        UNION ALL SELECT '7', PK, Name FROM i_track WHERE upper(Name) LIKE '%7%' UNION ALL SELECT 'xyzq', PK, Name FROM i_track WHERE upper(Name) LIKE '%XYZQ%'"""
    ),
)
def substring_index(spark, sf_dir):
    """Searches of a stored collection through lists of trigrams: only candidates' buckets are read."""
    tracks = track_items(store_tables(spark, sf_dir), STAMP)
    folder = scratch_path(spark, "search")
    store, index = Snapshots(spark, f"{folder}/items", KEYS), SubstringIndex(spark, f"{folder}/names", "Name")
    store.create(tracks)
    index.build(store.read())
    found = [index.search(store, text).select(F.lit(text).alias("text"), "PK", "Name") for text in ("RING", "l r", "7", "xyzq")]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("filter_by_genre", sql("SELECT PK, Name, GenreName FROM i_track WHERE GenreId = 7"))
def filter_by_genre(spark, sf_dir):
    found = access.where(music_catalog(store_tables(spark, sf_dir), STAMP), GenreId=7, EntityType="Track")
    return found.select("PK", "Name", "GenreName")


_ALL_KEYS = " UNION ALL ".join(
    f"SELECT PK, SK, EntityType FROM {v}"
    for v in ("i_artist", "i_album", "i_track", "i_customer", "i_invoice", "i_playlist", "i_playlisttrack", "i_employee")
)


@query("scan_limit", sql("SELECT PK, SK, EntityType FROM k ORDER BY PK, SK LIMIT 100", k=_ALL_KEYS))
def scan_limit(spark, sf_dir):
    items = [df.select("PK", "SK", "EntityType") for df in build_all(store_tables(spark, sf_dir), STAMP, lists=False).values()]
    return access.scan(reduce(lambda a, b: a.unionByName(b), items), limit=100)


@query("item_counts", sql("SELECT EntityType, count(*) AS item_count FROM k GROUP BY EntityType", k=_ALL_KEYS))
def item_counts(spark, sf_dir):
    items = [access.count_by_entity(df) for df in build_all(store_tables(spark, sf_dir), STAMP, lists=False).values()]
    return reduce(lambda a, b: a.unionByName(b), items)


@query(
    "track_three_way_join",
    sql(
        """SELECT t.TrackId AS TrackId, t.Name AS Name, a.Title AS Title, r.Name AS ArtistName FROM t_track t
        JOIN t_album a ON t.AlbumId = a.AlbumId JOIN t_artist r ON a.ArtistId = r.ArtistId"""
    ),
)
def track_three_way_join(spark, sf_dir):
    """The normalised form that one track item replaces."""
    tables = store_tables(spark, sf_dir)
    album = tables["Album"].select(F.col("AlbumId").alias("album"), "Title", "ArtistId")
    artist = tables["Artist"].select(F.col("ArtistId").alias("artist"), F.col("Name").alias("ArtistName"))
    # Albums and artists are unique; an album of very many tracks is spread where it is not broadcast.
    named = keyed_join(album, artist, "ArtistId", "artist", "inner").select("album", "Title", "ArtistName")
    joined = keyed_join(tables["Track"], named, "AlbumId", "album", "inner", rows_of=album)
    return joined.select("TrackId", "Name", "Title", "ArtistName")


@query(
    "customer_history_join",
    sql(
        """SELECT c.CustomerId AS CustomerId, i.InvoiceId AS InvoiceId, count(*) AS line_count FROM t_customer c
        JOIN t_invoice i ON c.CustomerId = i.CustomerId JOIN t_invoiceline l ON i.InvoiceId = l.InvoiceId
        GROUP BY c.CustomerId, i.InvoiceId"""
    ),
)
def customer_history_join(spark, sf_dir):
    """Customer, invoices and lines in normalised form; lines are counted before they are joined."""
    tables = store_tables(spark, sf_dir)
    lines = tables["InvoiceLine"].groupBy("InvoiceId").agg(F.count(F.lit(1)).alias("line_count"))
    invoices = tables["Invoice"].select("InvoiceId", "CustomerId").join(lines, "InvoiceId")  # unique on both sides
    customers = tables["Customer"].select(F.col("CustomerId").alias("customer"))
    return keyed_join(invoices, customers, "CustomerId", "customer", "left_semi").select("CustomerId", "InvoiceId", "line_count")


@query(
    "org_chart_depth",
    sql(
        "SELECT CustomerId, root, CAST(depth AS BIGINT) AS depth FROM walk",
        """walk AS (SELECT c_custkey AS CustomerId, c_custkey AS root, 0 AS depth FROM customer WHERE c_custkey // 10 = 0
        UNION ALL SELECT c.c_custkey, w.root, w.depth + 1 FROM walk w JOIN customer c ON c.c_custkey // 10 = w.CustomerId
        WHERE c.c_custkey // 10 <> 0)""",
    ),
)
def org_chart_depth(spark, sf_dir):
    """Top and depth of every customer in a tree of all customers."""
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS CustomerId", "c_custkey div 10 AS ReportsTo")
    return depths(people, "CustomerId", "ReportsTo")


_TREE = "SELECT c_custkey AS id, c_custkey // 10 AS up, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer"
_BELOW = """walk AS (SELECT id, up, cents, 0 AS depth, id AS node FROM t
    UNION ALL SELECT t.id, t.up, w.cents, w.depth + 1, w.node FROM walk w JOIN t ON t.id = w.up AND w.up <> 0)"""


def _org_labels(spark, sf_dir):
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS id", "c_custkey div 10 AS up", "c_acctbal")
    labels = subtree_labels(people, "id", "up")
    # Both sides have an id once.
    return labels.join(people.select("id", "c_acctbal"), "id")


@query(
    "subtree_totals",
    sql(
        """SELECT id, CAST(count(*) - 1 AS BIGINT) AS below, CAST(sum(CASE WHEN node <> id THEN cents ELSE 0 END) AS BIGINT) AS cents_below
        FROM walk GROUP BY id""",
        _BELOW,
        t=_TREE,
    ),
)
def subtree_totals_query(spark, sf_dir):
    """Number and balance of all customers below each one, at any level."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return subtree_totals(_org_labels(spark, sf_dir), {"cents_below": cents}).select("id", "below", "cents_below")


@query("reports_below", sql("SELECT id AS above, node AS below FROM walk WHERE depth > 0", _BELOW, t=_TREE))
def reports_below(spark, sf_dir):
    """Everyone below everyone: all subtrees at once."""
    return pairs_below(_org_labels(spark, sf_dir), "id")


@query(
    "one_subtree",
    sql("SELECT node AS id, depth FROM walk WHERE depth > 0 AND id = (SELECT min(id) FROM t)", _BELOW, t=_TREE),
)
def one_subtree(spark, sf_dir):
    """Everyone below the first customer, from stored labels: two bounds of the scan."""
    path = scratch_path(spark, "labels")
    write_labels(_org_labels(spark, sf_dir).select("id", "first", "last", F.col("depth").alias("level")), path)
    labels = spark.read.parquet(path)
    first = labels.agg(F.min("id")).first()[0]
    top = labels.filter(F.col("id") == first).select("level").scalar()
    return subtree(labels, "id", first).select("id", (F.col("level") - top).alias("depth"))
