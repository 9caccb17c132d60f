"""Loading, progress, recovery."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import functions as F

from keyweave.functions import composite_key
from keyweave.functions.codec import decode_items, encode_items
from keyweave.operators import ledger
from keyweave.operators.catalog import table_counts
from keyweave.operators.ordering import batches, resume_after
from keyweave.operators.upsert import keyed_upsert as upsert
from keyweave.operators.upsert import not_yet_written
from keyweave.plans.build import build
from keyweave.plans.catalog import album_items, artist_items, track_items
from keyweave.plans.customer import customer_data, customer_items
from keyweave.plans.employee import employee_data
from keyweave.plans.load import LoadFailed, load_collection, resume
from keyweave.plans.playlist import playlist_data
from keyweave.plans.store import INDEX1, INDEX2
from keyweave.session import scratch_path
from keyweave.sources.event_log import EventLog
from keyweave.sources.sink import put_items, read_put_items
from keyweave.sources.tables import CollectionStore
from keyweave.streaming.incremental import DeltaLog, PutLog, load_new_files
from keyweave.workload.adapter import STAMP, counts_sql, sql, store_tables
from keyweave.workload.registry import query

_CUSTOMER_KEYS = "SELECT PK, SK FROM i_customer UNION ALL SELECT PK, SK FROM i_invoice"


@query(
    "batch_assignment",
    sql("SELECT PK, SK, CAST((row_number() OVER (ORDER BY PK, SK) - 1) // 25 AS BIGINT) AS batch FROM k", k=_CUSTOMER_KEYS),
)
def batch_assignment(spark, sf_dir):
    items = customer_data(store_tables(spark, sf_dir), STAMP, lists=False).select("PK", "SK")
    return batches(items, ["PK", "SK"], size=25)


@query(
    "keyed_upsert",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END DESC,
    l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""",
)
def keyed_upsert(spark, sf_dir):
    """Lines of finished orders are put over the others; order and part are the key."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    finished = F.col("l_linestatus") == "F"
    return upsert(
        lines.filter(~finished).select(*columns),
        lines.filter(finished).select(*columns),
        keys=("l_orderkey", "l_partkey"),
        version=("l_linenumber",),
    )


@query("retrying_sink", sql("SELECT PK, SK, EntityType, (SELECT count(*) FROM i_playlisttrack) + (SELECT count(*) FROM i_playlist) AS written, CAST(0 AS BIGINT) AS unprocessed FROM (SELECT PK, SK, EntityType FROM i_playlisttrack UNION ALL SELECT PK, SK, EntityType FROM i_playlist)"))
def retrying_sink(spark, sf_dir):
    """Playlist items through the sink, and what the store holds afterwards."""
    items = playlist_data(store_tables(spark, sf_dir), STAMP)
    folder = scratch_path(spark, "sink")
    outcome = put_items(encode_items(items), "playlist_data", folder)
    keys = items.select("PK", "SK", "EntityType").schema
    stored = decode_items(read_put_items(spark, folder, "playlist_data"), keys)
    return stored.select(
        "*",
        outcome.select("written").scalar().alias("written"),
        outcome.select("unprocessed").scalar().alias("unprocessed"),
    )


def _store(spark):
    return CollectionStore(spark, prefix=f"kw_{uuid.uuid4().hex}_")


def _told(store, names):
    """Statistics of a store that is not needed any more: taken now (a row per collection), then it goes."""
    found = store.statistics(names)
    rows = found.collect()
    for name in names:
        store.drop(name)
    return store.spark.createDataFrame(rows, found.schema)


@query(
    "collection_lifecycle",
    sql(
        """SELECT 'playlist_data' AS collection, true AS found, (SELECT count(*) FROM i_playlist) + (SELECT count(*) FROM i_playlisttrack) AS item_count
        UNION ALL SELECT 'employee_data', true, (SELECT count(*) FROM i_employee)
        UNION ALL SELECT 'music_catalog', false, 0"""
    ),
)
def collection_lifecycle(spark, sf_dir):
    """Create, create again (kept), recreate by force, put, drop, drop again."""
    tables = store_tables(spark, sf_dir)
    store = _store(spark)
    playlists, employees = playlist_data(tables, STAMP), employee_data(tables, STAMP)
    store.create("playlist_data", playlists.filter("EntityType = 'Playlist'"))
    store.create("playlist_data", employees)
    store.upsert("playlist_data", playlists)
    store.create("employee_data", playlists)
    store.create("employee_data", employees, force=True)
    store.create("music_catalog", track_items(tables, STAMP))
    store.drop("music_catalog")
    store.drop("music_catalog")
    return _told(store, ["playlist_data", "employee_data", "music_catalog"])


@query(
    "store_puts",
    sql(
        """SELECT PK, SK, CASE WHEN TrackId % 5 = 0 THEN UnitPrice + CAST(1 AS DOUBLE) ELSE UnitPrice END AS UnitPrice,
        CASE WHEN TrackId % 5 = 0 THEN 'put' END AS Remark FROM i_track WHERE (TrackId % 3 <> 0 OR TrackId % 5 = 0) AND TrackId % 7 <> 0"""
    ),
)
def store_puts(spark, sf_dir):
    """A collection, a put with new prices and a new attribute, and a put that takes items out."""
    store, tracks = _store(spark), track_items(store_tables(spark, sf_dir), STAMP)
    raised = tracks.filter("TrackId % 5 = 0").withColumns({"UnitPrice": F.col("UnitPrice") + F.lit(1.0), "Remark": F.lit("put")})
    store.create("tracks", tracks.filter("TrackId % 3 <> 0"))
    store.upsert("tracks", raised)
    store.upsert("tracks", tracks.limit(0), removed=tracks.filter("TrackId % 7 = 0"))
    return store.read("tracks").select("PK", "SK", "UnitPrice", "Remark")


@query(
    "index_follows_puts",
    sql(
        """SELECT GSI1PK AS key, GSI1SK AS sort, PK, 'GSI1' AS index_name FROM i_customer WHERE CustomerId % 4 <> 2
        UNION ALL SELECT CASE WHEN CustomerId % 4 = 0 THEN 'SUPPORT_REP#' || (SupportRepId + 1) ELSE GSI2PK END, GSI2SK, PK, 'GSI2'
        FROM i_customer WHERE CustomerId % 4 IN (0, 3) AND GSI2PK IS NOT NULL"""
    ),
)
def index_follows_puts(spark, sf_dir):
    """Both indexes of the customers after a put that moves, ends and removes index keys."""
    store, profiles = _store(spark), customer_items(store_tables(spark, sf_dir), STAMP)
    store.create("customers", profiles)
    for index in (INDEX1, INDEX2):
        store.add_index("customers", index)
    turn = F.col("CustomerId") % 4
    moved = F.when((turn == 0) & F.col("GSI2PK").isNotNull(), composite_key("SUPPORT_REP", F.col("SupportRepId") + 1))
    store.upsert("customers", profiles.filter(turn < 2).withColumn("GSI2PK", moved), removed=profiles.filter(turn == 2))
    parts = [
        store.read_index("customers", i).select(F.col(i.partition).alias("key"), F.col(i.sort).alias("sort"), "PK", F.lit(i.name).alias("index_name"))
        for i in (INDEX1, INDEX2)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "target_stats",
    sql(
        """SELECT 'customer_data' AS collection, true AS found, (SELECT count(*) FROM i_customer) + (SELECT count(*) FROM i_invoice) AS item_count
        UNION ALL SELECT 'employee_data', true, (SELECT count(*) FROM i_employee)
        UNION ALL SELECT 'playlist_data', false, 0"""
    ),
)
def target_stats(spark, sf_dir):
    store = _store(spark)
    for name, items in build(["customer_data", "employee_data"], store_tables(spark, sf_dir), STAMP).items():
        store.create(name, items)
    return _told(store, ["customer_data", "employee_data", "playlist_data"])


@query(
    "ledger_init",
    sql(
        """SELECT table_name, 'not_started' AS status, record_count AS total, CAST(0 AS BIGINT) AS migrated, CAST(1 AS BIGINT) AS tables FROM c
        UNION ALL SELECT 'RUN', 'not_started', CAST(sum(record_count) AS BIGINT), 0, count(*) FROM c""",
        c=counts_sql(),
    ),
)
def ledger_init(spark, sf_dir):
    return ledger.ledger_start(table_counts(store_tables(spark, sf_dir)))


# A progress log made from the events: twelve tables, of which T11 was never initialised. Every third
# table completes, every third is started again. T98 has not begun, T99 is empty and complete.
_LOG = """
SELECT 'run1' AS run_id, (event_id + 1) * 10 AS seq, 'T' || CAST(user_id % 12 AS STRING) AS table_name,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'progress' END AS event, CAST(NULL AS BIGINT) AS total,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_id {div} 12 END AS migrated,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS STRING) END AS last_id,
  CASE WHEN event_type = 'error' THEN props END AS message, ts AS at FROM {events}
UNION ALL SELECT 'run1', 0, 'T' || CAST(user_id % 12 AS STRING), 'initialized', max(event_id) {div} 12 + 1, NULL, NULL, NULL, min(ts)
  FROM {events} WHERE user_id % 12 <> 11 GROUP BY user_id % 12
UNION ALL SELECT 'run1', 1, 'T' || CAST(user_id % 12 AS STRING), 'started', NULL, NULL, NULL, NULL, min(ts)
  FROM {events} GROUP BY user_id % 12
UNION ALL SELECT 'run1', 1000000000000, 'T' || CAST(user_id % 12 AS STRING),
  CASE user_id % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'started' ELSE 'progress' END, NULL,
  CASE user_id % 3 WHEN 2 THEN max(event_id) {div} 12 END, NULL, NULL, max(ts) FROM {events} GROUP BY user_id % 12, user_id % 3
UNION ALL SELECT 'run1', 2, 'T98', 'initialized', count(*), NULL, NULL, NULL, min(ts) FROM {events}
UNION ALL SELECT 'run1', 2, 'T99', 'initialized', 0, NULL, NULL, NULL, min(ts) FROM {events}
UNION ALL SELECT 'run1', 3, 'T99', 'completed', NULL, NULL, NULL, NULL, max(ts) FROM {events}
"""
_LOG_SQL = _LOG.format(div="//", events="events")


def _log(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(_LOG.replace("{div}", "div"), events=events)


def _newest_sql(value, *events):
    kinds = ", ".join(f"'{e}'" for e in events)
    return f"arg_max({value}, seq) FILTER (WHERE event IN ({kinds}) AND {value} IS NOT NULL)"


_PROGRESS = f"""SELECT table_name,
    CASE {_newest_sql("event", "initialized", "started", "completed", "error")} WHEN 'completed' THEN 'completed' WHEN 'error' THEN 'failed'
    WHEN 'started' THEN 'in_progress' ELSE 'not_started' END AS status,
    coalesce({_newest_sql("total", "initialized")}, 0) AS total, coalesce({_newest_sql("migrated", "progress")}, 0) AS counted,
    {_newest_sql("last_id", "progress")} AS last_id, count(*) FILTER (WHERE event = 'error') AS errors,
    {_newest_sql("message", "error")} AS last_error,
    epoch_us({_newest_sql('"at"', "completed")}) - epoch_us({_newest_sql('"at"', "started")}) AS duration_us
    FROM log GROUP BY table_name HAVING count(*) FILTER (WHERE event = 'initialized') > 0"""
_TABLES = """SELECT table_name, status, total, CASE WHEN status = 'completed' THEN total ELSE counted END AS migrated,
    last_id, errors, last_error, duration_us FROM p"""
_PERCENT = """CASE WHEN {done} THEN CAST(100 AS DOUBLE) WHEN total = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(migrated AS DOUBLE) / CAST(total AS DOUBLE) * CAST(100 AS DOUBLE) END AS progress"""
_TABLE_PERCENT = _PERCENT.format(done="status = 'completed'")
_VIEWS = {"log": _LOG_SQL, "p": _PROGRESS, "s": _TABLES}


@query(
    "progress_status",
    sql(
        f"SELECT table_name, status, total, migrated, {_TABLE_PERCENT}, errors, last_error, duration_us FROM s",
        **_VIEWS,
    ),
)
def progress_status(spark, sf_dir):
    return ledger.table_progress(_log(spark, sf_dir)).select(
        "table_name", "status", "total", "migrated", "progress", "errors", "last_error", "duration_us"
    )


@query(
    "run_status",
    sql(
        f"""SELECT *, {_PERCENT.format(done='completed_tables = total_tables')} FROM (SELECT 'in_progress' AS status, count(*) AS total_tables,
        count(*) FILTER (WHERE status = 'completed') AS completed_tables, CAST(sum(total) AS BIGINT) AS total,
        CAST(sum(migrated) AS BIGINT) AS migrated, (SELECT count(*) FROM log WHERE event = 'error') AS errors FROM s)""",
        **_VIEWS,
    ),
)
def run_status(spark, sf_dir):
    return ledger.run_progress(_log(spark, sf_dir)).select(
        "status", "total_tables", "completed_tables", "total", "migrated", "errors", "progress"
    )


@query("resume_tables", sql("SELECT table_name, status, migrated, total, last_id FROM s WHERE status <> 'completed'", **_VIEWS))
def resume_tables(spark, sf_dir):
    return ledger.resume_tables(_log(spark, sf_dir)).drop("run_id")


@query(
    "resume_targets",
    sql(
        """SELECT 'C' || (CAST(substr(table_name, 2) AS BIGINT) % 4) AS collection, count(*) AS unfinished_tables,
        CAST(sum(total - migrated) AS BIGINT) AS open_records FROM s WHERE status <> 'completed' GROUP BY 1""",
        **_VIEWS,
    ),
)
def resume_targets(spark, sf_dir):
    log = _log(spark, sf_dir)
    mapping = log.select("table_name").distinct().selectExpr(
        "table_name", "'C' || CAST(CAST(substr(table_name, 2) AS BIGINT) % 4 AS STRING) AS collection"
    )
    return ledger.resume_targets(log, mapping).drop("run_id")


@query("resume_remaining", sql("SELECT PK, SK FROM i_track WHERE AlbumId IS NULL"))
def resume_remaining(spark, sf_dir):
    """Tracks still to be written when those with an album are."""
    items = track_items(store_tables(spark, sf_dir), STAMP)
    written = items.filter(F.col("AlbumId").isNotNull()).select("PK", "SK")
    return not_yet_written(items, written).select("PK", "SK")


@query("resume_offset", sql("SELECT PK, SK FROM k ORDER BY PK, SK OFFSET 1000", k=_CUSTOMER_KEYS))
def resume_offset(spark, sf_dir):
    items = customer_data(store_tables(spark, sf_dir), STAMP, lists=False).select("PK", "SK")
    return resume_after(items, ["PK", "SK"], 1000)


@query(
    "error_rollup",
    sql(
        """SELECT table_name, count(*) AS error_count, arg_max(message, seq) AS last_error FROM log WHERE event = 'error' GROUP BY table_name
        UNION ALL SELECT 'RUN', count(*), arg_max(message, seq) FROM log WHERE event = 'error'""",
        log=_LOG_SQL,
    ),
)
def error_rollup(spark, sf_dir):
    return ledger.errors(_log(spark, sf_dir)).drop("run_id")


# Saved states of every kind: whole, plain text, cut off inside a value, without an id, without a status.
_STATES = """SELECT event_id, CASE event_id % 7
  WHEN 1 THEN 'run;' || event_type WHEN 2 THEN '{{"migration_id": "run-' || CAST(event_id AS STRING)
  WHEN 3 THEN '{{"status": "' || event_type || '", "tables": 3}}' WHEN 4 THEN '{{"migration_id": "run-' || CAST(event_id AS STRING) || '"}}'
  ELSE '{{"migration_id": "run-' || CAST(event_id AS STRING) || '", "status": "' || event_type || '", "total_records": 5}}' END AS state
FROM {events}"""


@query(
    "corrupt_state",
    sql(
        """SELECT event_id, CASE WHEN NOT json_valid(state) THEN 'unreadable'
        WHEN id IS NULL OR status IS NULL THEN 'incomplete' ELSE 'valid' END AS verdict, id AS migration_id, status
        FROM (SELECT event_id, state, CASE WHEN json_valid(state) THEN json_extract_string(state, '$.migration_id') END AS id,
        CASE WHEN json_valid(state) THEN json_extract_string(state, '$.status') END AS status FROM s)""",
        s=_STATES.format(events="events"),
    ),
)
def corrupt_state(spark, sf_dir):
    states = spark.sql(_STATES, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    checked = ledger.check_states(states)
    readable = F.col("verdict") != "unreadable"
    return checked.select(
        "event_id", "verdict", F.when(readable, F.col("migration_id")).alias("migration_id"), F.when(readable, F.col("status")).alias("status")
    )


_RATES = """SELECT {name} AS table_name, CAST(sum(records) AS BIGINT) AS records, count(*) AS batches,
    epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us FROM b"""


@query(
    "throughput",
    sql(
        """SELECT *, CASE WHEN span_us > 0 THEN CAST(records AS DOUBLE) / (CAST(span_us AS DOUBLE) / CAST(1000000 AS DOUBLE))
        ELSE CAST(0 AS DOUBLE) END AS rate FROM r""",
        b="SELECT event_type, ts, CAST(floor(value) AS BIGINT) AS records FROM events",
        r=_RATES.format(name="event_type") + " GROUP BY event_type UNION ALL " + _RATES.format(name="'RUN'"),
    ),
)
def throughput(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ledger.throughput(
        events.select(F.col("event_type").alias("table_name"), F.floor("value").alias("records"), F.col("ts").alias("at"))
    )


_TWO_LOADS = """SELECT 'CUSTOMER#' || o_custkey AS PK, 'INVOICE#' || o_orderkey AS SK,
    CASE WHEN o_orderstatus = 'P' THEN o_totalprice + CAST(1 AS DOUBLE) ELSE o_totalprice END AS Total FROM orders"""


def _two_loads(spark, sf_dir, folder, log):
    """First the open and pending orders, then the finished ones and changed pending ones."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")

    def to_items(rows):
        return rows.select(
            composite_key("CUSTOMER", "o_custkey").alias("PK"),
            composite_key("INVOICE", "o_orderkey").alias("SK"),
            F.col("o_totalprice").alias("Total"),
        )

    pending = F.col("o_orderstatus") == "P"
    finished = F.col("o_orderstatus") == "F"
    changed = F.when(pending, F.col("o_totalprice") + F.lit(1.0)).otherwise(F.col("o_totalprice"))
    for arrival in (orders.filter(~finished), orders.filter(finished | pending).withColumn("o_totalprice", changed)):
        arrival.write.mode("append").parquet(f"{folder}/source")
        load_new_files(spark, f"{folder}/source", orders.schema, to_items, log, f"{folder}/checkpoint")
    return log.read()


@query("incremental_load", _TWO_LOADS)
def incremental_load(spark, sf_dir):
    """Two loads as deltas; readers take the newest write of each key."""
    folder = scratch_path(spark, "incremental")
    return _two_loads(spark, sf_dir, folder, DeltaLog(spark, f"{folder}/items"))


@query("incremental_puts", _TWO_LOADS)
def incremental_puts(spark, sf_dir):
    """The same two loads put into versions of a bucketed table."""
    folder = scratch_path(spark, "incremental")
    return _two_loads(spark, sf_dir, folder, PutLog(spark, f"{folder}/items"))


def _track_parts(tables):
    """Items of the music catalogue by source table."""
    return {"Artist": artist_items(tables, STAMP), "Album": album_items(tables, STAMP), "Track": track_items(tables, STAMP)}


def _stopped(items):
    """Items whose source breaks off in the middle of the second of four slices."""
    second = F.pmod(F.xxhash64(F.lit(4), "PK", "SK"), F.lit(4)) == 1
    return items.withColumn("Name", F.when(second, F.raise_error(F.lit("source went away"))).otherwise(F.col("Name")))


def _stopped_and_resumed(spark, sf_dir):
    """A load that stops in the tracks, after artists and albums; some tracks are there without an entry in the log."""
    tables = store_tables(spark, sf_dir)
    store, parts = _store(spark), _track_parts(tables)
    log = EventLog(spark, scratch_path(spark, "log"), "run1")
    log.initialize(table_counts({t: tables[t] for t in parts}))
    with contextlib.suppress(LoadFailed):
        load_collection(store, log, "music_catalog", {**parts, "Track": _stopped(parts["Track"])}, slices=4)
    store.upsert("music_catalog", parts["Track"].filter("TrackId % 2 = 0"))
    log.pause()
    load_collection(store, log, "music_catalog", parts, slices=4)  # a paused run does nothing
    log.resume()
    resume(store, log, {"music_catalog": parts, "employee_data": {"Employee": employee_data(tables, STAMP)}}, slices=4)
    return store, log


@query(
    "resume_load",
    sql(
        """SELECT PK, SK, EntityType, GSI1PK FROM i_artist UNION ALL SELECT PK, SK, EntityType, GSI1PK FROM i_album
        UNION ALL SELECT PK, SK, EntityType, GSI1PK FROM i_track"""
    ),
)
def resume_load(spark, sf_dir):
    """The whole collection after a stopped, paused and resumed load."""
    return _stopped_and_resumed(spark, sf_dir)[0].read("music_catalog").select("PK", "SK", "EntityType", "GSI1PK")


@query(
    "load_ledger",
    sql(
        """SELECT table_name, 'completed' AS status, record_count AS total, record_count AS migrated, CAST(100 AS DOUBLE) AS progress,
        CAST(CASE WHEN table_name = 'Track' THEN 1 ELSE 0 END AS BIGINT) AS errors FROM c WHERE table_name IN ('Artist', 'Album', 'Track')
        UNION ALL SELECT 'RUN', 'completed', CAST(sum(record_count) AS BIGINT), CAST(sum(record_count) AS BIGINT), 100, 1 FROM c
        WHERE table_name IN ('Artist', 'Album', 'Track')""",
        c=counts_sql(),
    ),
)
def load_ledger(spark, sf_dir):
    """What the events that the same load wrote add up to, per table and for the run."""
    log = _stopped_and_resumed(spark, sf_dir)[1].read()
    columns = ("table_name", "status", "total", "migrated", "progress", "errors")
    run = ledger.run_progress(log).withColumn("table_name", F.lit("RUN"))
    return ledger.table_progress(log).select(*columns).unionByName(run.select(*columns))
