"""Sources and catalogue profiling."""

from __future__ import annotations

import os
import sqlite3
import uuid

from pyspark.sql import functions as F

from keyweave.operators import catalog
from keyweave.operators.hierarchy import layers
from keyweave.operators.kept_profile import LG_K, kept_profile
from keyweave.operators.ordering import page
from keyweave.plans.store import TABLES
from keyweave.session import scratch_path
from keyweave.sources.sink import local_folder
from keyweave.sources.snapshots import Snapshots
from keyweave.sources.sqlite import read_sqlite
from keyweave.sources.tables import read_tables
from keyweave.specs import TableSpec
from keyweave.workload.adapter import RAW, TABLE_VIEWS, counts_sql, sql, store_tables
from keyweave.workload.registry import query


@query("scan_table", "SELECT * FROM part")
def scan_table(spark, sf_dir):
    return read_tables(spark, sf_dir, ["part"])["part"]


_ORDERS = "o_orderkey, o_custkey, o_totalprice"


@query("page_rows", f"SELECT {_ORDERS} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500 OFFSET 1000")
def page_rows(spark, sf_dir):
    orders = read_tables(spark, sf_dir, ["orders"])["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return page(orders, [F.desc("o_totalprice"), "o_orderkey"], limit=500, offset=1000)


@query("page_rows_deep", f"SELECT {_ORDERS} FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 700")
def page_rows_deep(spark, sf_dir):
    """Everything behind an offset, without moving it through one task."""
    orders = read_tables(spark, sf_dir, ["orders"])["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return page(orders, [F.desc("o_totalprice"), "o_orderkey"], offset=700)


def _write_shards(folder: str):
    """Each task writes its rows to a file of its own."""

    def write(frames):
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"{uuid.uuid4().hex}.part")
        rows = 0
        with sqlite3.connect(path) as db:
            db.execute("CREATE TABLE Customer (CustomerId INTEGER PRIMARY KEY, Name TEXT NOT NULL, Balance REAL, Segment TEXT)")
            for frame in frames:
                db.executemany("INSERT INTO Customer VALUES (?, ?, ?, ?)", frame.itertuples(index=False, name=None))
                rows += len(frame)
        db.close()
        import pandas as pd

        yield pd.DataFrame({"path": [path], "rows": [rows]})

    return write


@query("sqlite_source", "SELECT c_custkey AS CustomerId, c_name AS Name, c_acctbal AS Balance, c_mktsegment AS Segment FROM customer")
def sqlite_source(spark, sf_dir):
    """Customers written to SQLite files by the tasks, then read back in parallel.

    Only files of successful task attempts are published (renamed), so a repeated task adds no rows.
    """
    customer = read_tables(spark, sf_dir, ["customer"])["customer"]
    folder = local_folder(scratch_path(spark, "sqlite"))
    rows = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    written = rows.repartition(4, "c_custkey").mapInPandas(_write_shards(folder), "path string, rows bigint").collect()
    for shard in written:
        os.rename(shard["path"], shard["path"].removesuffix(".part") + ".sqlite")
    return read_sqlite(spark, folder, "Customer")


# Columns of the profiled tables, for the generated check.
_RAW_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
}
_RAW_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
    "part": "p_partkey", "orders": "o_orderkey",
}
_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {str(_RAW_KEYS.get(t) == c).lower()} AS primary_key, "
    f"count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM {t}"
    for t, cs in _RAW_COLUMNS.items()
    for c in cs.split()
)


@query("profile_columns", _PROFILE_SQL)
def profile_columns(spark, sf_dir):
    specs = {t: TableSpec(t, (_RAW_KEYS[t],) if t in _RAW_KEYS else ()) for t in RAW}
    found = catalog.profile_columns(spark, read_tables(spark, sf_dir, RAW), specs, exact=True)
    return found.select("table_name", "column_name", "primary_key", "row_count", "null_count", "distinct_count")


@query(
    "catalog_counts",
    sql("SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(record_count) AS BIGINT) FROM c", c=counts_sql()),
)
def catalog_counts(spark, sf_dir):
    return catalog.catalog_counts(store_tables(spark, sf_dir))


_LINKS = [
    (t, fk.column, fk.table, fk.ref_column) for t, s in TABLES.items() for fk in s.foreign_keys
]
_EDGES = " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{r}' AS r, count(*) AS n FROM {TABLE_VIEWS[t]} WHERE {c} IS NOT NULL" for t, c, r, _ in _LINKS
)


@query(
    "fk_relationships",
    sql(
        """SELECT table_name, record_count,
        coalesce((SELECT string_agg(r, ',' ORDER BY r) FROM e WHERE t = table_name), '') AS refs,
        coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM e WHERE r = table_name), '') AS referenced_by,
        coalesce((SELECT CAST(sum(n) AS BIGINT) FROM e WHERE t = table_name), 0) AS outgoing_rows,
        coalesce((SELECT CAST(sum(n) AS BIGINT) FROM e WHERE r = table_name), 0) AS incoming_rows FROM c""",
        e=_EDGES,
        c=counts_sql(),
    ),
)
def fk_relationships(spark, sf_dir):
    found = catalog.relationships(store_tables(spark, sf_dir), TABLES)
    return found.select(
        "table_name",
        "record_count",
        F.array_join("references", ",").alias("refs"),
        F.array_join("referenced_by", ",").alias("referenced_by"),
        "outgoing_rows",
        "incoming_rows",
    )


@query(
    "related_rows",
    sql(
        """SELECT 'InvoiceLine' AS child, l.TrackId AS TrackId, count(*) AS child_rows FROM t_invoiceline l
        JOIN t_track t ON t.TrackId = l.TrackId WHERE t.AlbumId IS NULL GROUP BY l.TrackId
        UNION ALL SELECT 'PlaylistTrack', p.TrackId, count(*) FROM t_playlisttrack p
        JOIN t_track t ON t.TrackId = p.TrackId WHERE t.AlbumId IS NULL GROUP BY p.TrackId"""
    ),
)
def related_rows(spark, sf_dir):
    """Rows in all tables that point to a track without an album."""
    tables = store_tables(spark, sf_dir)
    keys = tables["Track"].filter(F.col("AlbumId").isNull())
    parts = [
        rows.groupBy("TrackId").agg(F.count(F.lit(1)).alias("child_rows")).select(F.lit(name).alias("child"), "TrackId", "child_rows")
        for name, rows in catalog.related_data_present(tables, TABLES, "Track", keys).items()
    ]
    return catalog._union(parts)


_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS fk_column, '{r}.{k}' AS reference, count(*) AS orphan_count
    FROM {TABLE_VIEWS[t]} x LEFT JOIN {TABLE_VIEWS[r]} y ON x.{c} = y.{k} WHERE x.{c} IS NOT NULL AND y.{k} IS NULL"""
    for t, c, r, k in _LINKS
)


@query(
    "fk_orphans",
    sql(
        """SELECT *, 'Found ' || orphan_count || ' orphaned records in ' || fk_column || ' referencing ' || reference AS message
        FROM o WHERE orphan_count > 0""",
        o=_ORPHANS,
    ),
)
def fk_orphans(spark, sf_dir):
    return catalog.orphans(store_tables(spark, sf_dir), TABLES)


_ANALYSIS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{','.join(s.primary_key)}' AS primary_keys, CAST({len(s.foreign_keys)} AS BIGINT) AS fk_count"
    for t, s in TABLES.items()
)
_COLUMN_COUNTS = {
    "Artist": 2, "Album": 3, "Genre": 2, "MediaType": 2, "Track": 6, "Employee": 4, "Customer": 6, "Invoice": 4,
    "InvoiceLine": 5, "Playlist": 2, "PlaylistTrack": 2,
}
_COLUMN_CASE = "CASE table_name " + " ".join(f"WHEN '{t}' THEN CAST({n} AS BIGINT)" for t, n in _COLUMN_COUNTS.items()) + " END"


@query(
    "schema_analysis",
    sql(
        f"SELECT table_name, record_count, {_COLUMN_CASE} AS column_count, primary_keys, fk_count FROM c JOIN a USING (table_name)",
        c=counts_sql(),
        a=_ANALYSIS,
    ),
)
def schema_analysis(spark, sf_dir):
    """The analysis written as JSON and read back."""
    path = scratch_path(spark, "schema-analysis")
    analysis = catalog.schema_analysis(spark, store_tables(spark, sf_dir), TABLES)
    analysis.write.json(path)
    return spark.read.schema(analysis.schema).json(path).select(
        "table_name",
        "record_count",
        F.size("columns").cast("bigint").alias("column_count"),
        F.array_join("primary_keys", ",").alias("primary_keys"),
        F.coalesce(F.size("foreign_keys"), F.lit(0)).cast("bigint").alias("fk_count"),
    )


_GRAPH = {
    "nodes": """SELECT 'REGION#' || r_regionkey AS node FROM region UNION ALL SELECT 'NATION#' || n_nationkey FROM nation
        UNION ALL SELECT 'CUSTOMER#' || c_custkey FROM customer""",
    "links": """SELECT 'NATION#' || n_nationkey AS node, 'REGION#' || n_regionkey AS needs FROM nation
        UNION ALL SELECT 'CUSTOMER#' || c_custkey, 'NATION#' || c_nationkey FROM customer
        UNION ALL SELECT 'CUSTOMER#' || c_custkey, 'CUSTOMER#' || (c_custkey // 10) FROM customer WHERE c_custkey // 10 <> 0""",
}


@query(
    "dependency_layers",
    sql(
        "SELECT node, CAST(max(depth) AS BIGINT) AS layer FROM walk GROUP BY node",
        """walk AS (SELECT node, 0 AS depth FROM nodes
        UNION SELECT l.node, w.depth + 1 FROM walk w JOIN links l ON l.needs = w.node)""",
        **_GRAPH,
    ),
)
def dependency_layers(spark, sf_dir):
    """Layers of a graph over rows: regions, nations, customers, and customers below customers."""
    raw = read_tables(spark, sf_dir, ("region", "nation", "customer"))

    def name(prefix, column):
        return F.concat(F.lit(f"{prefix}#"), F.expr(column).cast("string"))

    nodes = catalog._union(
        [
            raw["region"].select(name("REGION", "r_regionkey").alias("node")),
            raw["nation"].select(name("NATION", "n_nationkey").alias("node")),
            raw["customer"].select(name("CUSTOMER", "c_custkey").alias("node")),
        ]
    )
    customers = raw["customer"]
    links = catalog._union(
        [
            raw["nation"].select(name("NATION", "n_nationkey").alias("node"), name("REGION", "n_regionkey").alias("needs")),
            customers.select(name("CUSTOMER", "c_custkey").alias("node"), name("NATION", "c_nationkey").alias("needs")),
            customers.filter("c_custkey div 10 <> 0").select(
                name("CUSTOMER", "c_custkey").alias("node"), name("CUSTOMER", "c_custkey div 10").alias("needs")
            ),
        ]
    )
    return layers(nodes, links)


_LAYERS = {
    "Artist": 0, "Genre": 0, "MediaType": 0, "Employee": 0, "Playlist": 0, "Album": 1, "Customer": 1,
    "Track": 2, "Invoice": 2, "InvoiceLine": 3, "PlaylistTrack": 3,
}
_LAYER_CASE = "CASE table_name " + " ".join(f"WHEN '{t}' THEN CAST({n} AS BIGINT)" for t, n in _LAYERS.items()) + " END"


@query("table_load_order", sql(f"SELECT table_name, {_LAYER_CASE} AS layer, record_count FROM c", c=counts_sql()))
def table_load_order(spark, sf_dir):
    return catalog.load_order(spark, store_tables(spark, sf_dir), TABLES)


@query(
    "source_stats",
    sql(
        f"SELECT table_name, record_count, {_COLUMN_CASE} AS column_count, fk_count > 0 AS has_foreign_keys FROM c JOIN a USING (table_name)",
        c=counts_sql(),
        a=_ANALYSIS,
    ),
)
def source_stats(spark, sf_dir):
    return catalog.source_statistics(store_tables(spark, sf_dir), TABLES)


@query(
    "profile_after_put",
    """SELECT 'PK' AS column_name, count(*) AS row_count, CAST(0 AS BIGINT) AS null_count, true AS within_bound FROM orders WHERE o_orderkey % 5 <> 4
    UNION ALL SELECT 'o_custkey', count(*), 0, true FROM orders WHERE o_orderkey % 5 <> 4
    UNION ALL SELECT 'o_orderstatus', count(*), count(*) FILTER (WHERE o_orderkey % 5 = 3), true FROM orders WHERE o_orderkey % 5 <> 4
    UNION ALL SELECT 'o_totalprice', count(*), 0, true FROM orders WHERE o_orderkey % 5 <> 4""",
)
def profile_after_put(spark, sf_dir):
    """Profile of stored orders, kept over a put that empties a column of some and one that removes others.

    Distinct counts are estimates: they are told as whether they lie within four standard errors of the exact ones.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.lit("INVOICE#"), "o_orderkey").alias("PK"), "o_custkey", "o_orderstatus", "o_totalprice"
    )
    turn = F.split_part("PK", F.lit("#"), F.lit(2)).cast("bigint") % 5
    store = Snapshots(spark, scratch_path(spark, "profiled"), ("PK",))
    store.create(orders)
    kept_profile(store).count()  # so that later profiles only read what the puts write
    store.put(orders.filter(turn == 3).withColumn("o_orderstatus", F.lit(None).cast("string")))
    store.put(removed=orders.filter(turn == 4))
    now = store.read()
    exact = now.select([F.count_distinct(c).alias(c) for c in now.columns])
    exact = exact.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, now.columns)), F.array(*now.columns))).alias("column_name", "exact"))
    bound = F.greatest(F.lit(1.0), F.col("exact") * (4 * 1.04 / 2 ** (LG_K / 2)))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= bound
    return kept_profile(store).join(exact, "column_name").select("column_name", "row_count", "null_count", near.alias("within_bound"))
