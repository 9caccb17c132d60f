"""Validation and reporting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from keyweave.operators import reconcile
from keyweave.plans.build import build_all
from keyweave.plans.customer import customer_items
from keyweave.plans.store import COLLECTIONS
from keyweave.workload.adapter import STAMP, TABLE_VIEWS, sql, store_tables
from keyweave.workload.registry import query

_ITEM_VIEWS = {
    "music_catalog": ("i_artist", "i_album", "i_track"),
    "customer_data": ("i_customer", "i_invoice"),
    "playlist_data": ("i_playlist", "i_playlisttrack"),
    "employee_data": ("i_employee",),
}

# Faults put into the customer profiles, the same in Spark and in the check.
_DAMAGE = {
    "PK": "CASE WHEN CustomerId % 13 = 0 THEN NULL WHEN CustomerId % 17 = 1 THEN 'X#' || PK ELSE PK END",
    "SK": "CASE WHEN CustomerId % 19 = 2 THEN NULL ELSE SK END",
    "EntityType": "CASE WHEN CustomerId % 29 = 6 THEN NULL ELSE EntityType END",
    "CreatedAt": "CASE WHEN CustomerId % 7 = 3 THEN NULL ELSE 'now' END",
    "UpdatedAt": "CASE WHEN CustomerId % 5 = 1 THEN NULL ELSE 'now' END",
    "Email": "CASE WHEN CustomerId % 11 = 4 THEN NULL ELSE Email END",
    "LastName": "CASE WHEN CustomerId % 23 = 5 THEN NULL ELSE LastName END",
}
_DAMAGED_SQL = (
    "SELECT CustomerId, FirstName, " + ", ".join(f"{body} AS {name}" for name, body in _DAMAGE.items()) + " FROM i_customer"
)
_KEY_SQL = """SELECT PK, 'key_presence' AS "check", 'missing PK' AS message FROM d WHERE PK IS NULL
    UNION ALL SELECT PK, 'key_presence', 'missing SK' FROM d WHERE PK IS NOT NULL AND SK IS NULL
    UNION ALL SELECT PK, 'key_format', 'PK without a known prefix' FROM d WHERE SK IS NOT NULL AND PK NOT LIKE 'CUSTOMER#%'"""
_FIRST = """CASE WHEN EntityType IS NULL THEN 'EntityType' WHEN CreatedAt IS NULL THEN 'CreatedAt' WHEN UpdatedAt IS NULL THEN 'UpdatedAt' END"""
_REQUIRED_SQL = f"SELECT PK, 'required' AS \"check\", 'missing ' || {_FIRST} AS message FROM d WHERE {_FIRST} IS NOT NULL"
_ENTITY_SQL = """SELECT PK, 'entity_required' AS "check", 'CustomerProfile without ' || concat_ws(', ',
    CASE WHEN LastName IS NULL THEN 'LastName' END, CASE WHEN Email IS NULL THEN 'Email' END) AS message
    FROM d WHERE EntityType = 'CustomerProfile' AND (LastName IS NULL OR Email IS NULL)"""
_COUNTED = """SELECT 'customer_data' AS collection, "check", message, count(*) AS items, min(PK) AS example FROM f GROUP BY "check", message"""


def damaged(items):
    return items.withColumns({name: F.expr(body) for name, body in _DAMAGE.items()})


def _damaged_profiles(spark, sf_dir):
    return damaged(customer_items(store_tables(spark, sf_dir), STAMP))


_SPEC = COLLECTIONS["customer_data"]


@query("key_presence", sql(_COUNTED + " HAVING \"check\" = 'key_presence'", d=_DAMAGED_SQL, f=_KEY_SQL))
def key_presence(spark, sf_dir):
    items = _damaged_profiles(spark, sf_dir)
    return reconcile.faults(items, _SPEC, reconcile.key_faults(items, _SPEC)[:2])


@query("key_format", sql(_COUNTED + " HAVING \"check\" = 'key_format'", d=_DAMAGED_SQL, f=_KEY_SQL))
def key_format(spark, sf_dir):
    items = _damaged_profiles(spark, sf_dir)
    return reconcile.faults(items, _SPEC, reconcile.key_faults(items, _SPEC)[2:])


@query("required_fields", sql(_COUNTED, d=_DAMAGED_SQL, f=_REQUIRED_SQL))
def required_fields(spark, sf_dir):
    items = _damaged_profiles(spark, sf_dir)
    return reconcile.faults(items, _SPEC, reconcile.required_faults(items))


@query("entity_required_fields", sql(_COUNTED, d=_DAMAGED_SQL, f=_ENTITY_SQL))
def entity_required_fields(spark, sf_dir):
    items = _damaged_profiles(spark, sf_dir)
    return reconcile.faults(items, _SPEC, reconcile.entity_faults(items, _SPEC))


# The same checks over every item of all four collections, with faults by the items' own numbers.
_NUMBERS = {
    "Artist": "ArtistId", "Album": "AlbumId", "Track": "TrackId", "CustomerProfile": "CustomerId", "Invoice": "InvoiceId",
    "Playlist": "PlaylistId", "PlaylistTrack": "PlaylistId * 31 + TrackId", "EmployeeProfile": "EmployeeId",
}
_KEYS_AND_STAMPS = {
    "PK": "CASE WHEN {n} % 13 = 0 THEN NULL WHEN {n} % 17 = 1 THEN 'X#' || PK ELSE PK END",
    "SK": "CASE WHEN {n} % 19 = 2 THEN NULL ELSE SK END",
    "EntityType": "CASE WHEN {n} % 29 = 6 THEN NULL ELSE EntityType END",
    "CreatedAt": "CASE WHEN {n} % 7 = 3 THEN NULL ELSE 'now' END",
    "UpdatedAt": "CASE WHEN {n} % 5 = 1 THEN NULL ELSE 'now' END",
}


def _lost(place):
    """When the attribute at a place among the required ones of an entity is taken out."""
    return f"{{n}} % {11 + 2 * place} = 4"


def _damaged_collections(spark, sf_dir):
    found = {}
    for name, items in build_all(store_tables(spark, sf_dir), STAMP, lists=False).items():
        required = COLLECTIONS[name].required
        number = "CASE EntityType " + " ".join(f"WHEN '{e}' THEN {_NUMBERS[e]}" for e in required) + " END"
        lost: dict[str, list[str]] = {}
        for entity, columns in required.items():
            for place, c in enumerate(columns):
                lost.setdefault(c, []).append(f"EntityType = '{entity}' AND " + _lost(place).format(n="n"))
        changes = {c: body.format(n="n") for c, body in _KEYS_AND_STAMPS.items()}
        changes |= {c: f"CASE WHEN NOT ({' OR '.join(when)}) OR EntityType IS NULL THEN {c} END" for c, when in lost.items()}
        found[name] = items.withColumn("n", F.expr(number)).withColumns({c: F.expr(x) for c, x in changes.items()}).drop("n")
    return found


def _damaged_sql():
    """Per item: collection, damaged keys and stamps, and which required attributes of its entity are gone."""
    views = {e: v for n, vs in _ITEM_VIEWS.items() for e, v in zip(COLLECTIONS[n].required, vs)}
    parts = []
    for name, spec in COLLECTIONS.items():
        known = " OR ".join(f"PK LIKE '{p}%'" for p in spec.key_prefixes)
        for entity, columns in spec.required.items():
            gone = ", ".join(f"CASE WHEN {_lost(place).format(n='n')} THEN '{c}' END" for place, c in enumerate(columns))
            body = ", ".join(f"{x.format(n='n')} AS {c}" for c, x in _KEYS_AND_STAMPS.items())
            inner = f"SELECT {body}, concat_ws(', ', {gone}) AS gone FROM (SELECT *, {_NUMBERS[entity]} AS n FROM {views[entity]})"
            parts.append(f"SELECT '{name}' AS collection, '{entity}' AS entity, ({known}) AS known, * FROM ({inner})")
    return " UNION ALL ".join(parts)


_EVERY_FAULT = f"""SELECT collection, PK, 'key_presence' AS "check", CASE WHEN PK IS NULL THEN 'missing PK' ELSE 'missing SK' END AS message
    FROM d WHERE PK IS NULL OR SK IS NULL
    UNION ALL SELECT collection, PK, 'key_format', 'PK without a known prefix' FROM d WHERE PK IS NOT NULL AND SK IS NOT NULL AND NOT known
    UNION ALL SELECT collection, PK, 'required', 'missing ' || {_FIRST} FROM d WHERE {_FIRST} IS NOT NULL
    UNION ALL SELECT collection, PK, 'entity_required', entity || ' without ' || gone FROM d WHERE EntityType IS NOT NULL AND gone <> ''"""


@query(
    "collection_faults",
    sql(
        """SELECT collection, "check", message, count(*) AS items, min(PK) AS example FROM f GROUP BY collection, "check", message""",
        d=_damaged_sql(),
        f=_EVERY_FAULT,
    ),
)
def collection_faults(spark, sf_dir):
    """Key presence, key format, required and entity-specific attributes of all items of all collections."""
    parts = [reconcile.item_faults(items, COLLECTIONS[name]) for name, items in _damaged_collections(spark, sf_dir).items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "audit_stamps",
    sql(
        " UNION ALL ".join(
            f"SELECT '{n}' AS collection, EntityType, '{STAMP}' AS created, '{STAMP}' AS updated, count(*) AS items FROM {v} GROUP BY EntityType"
            for n, views in _ITEM_VIEWS.items()
            for v in views
        )
    ),
)
def audit_stamps(spark, sf_dir):
    """Every item of every collection carries the stamps of its run."""
    parts = [
        items.groupBy("EntityType", F.col("CreatedAt").alias("created"), F.col("UpdatedAt").alias("updated"))
        .agg(F.count(F.lit(1)).alias("items"))
        .select(F.lit(name).alias("collection"), "EntityType", "created", "updated", "items")
        for name, items in build_all(store_tables(spark, sf_dir), STAMP, lists=False).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("sample_items", sql("SELECT PK, SK, FirstName, Email FROM i_customer ORDER BY PK, SK LIMIT 10"))
def sample_items(spark, sf_dir):
    return reconcile.sample(customer_items(store_tables(spark, sf_dir), STAMP), 10).select("PK", "SK", "FirstName", "Email")


def _total(views):
    return " + ".join(f"(SELECT count(*) FROM {v})" for v in views)


_COUNTS = " UNION ALL ".join(
    f"""SELECT '{n}' AS collection, {_total(TABLE_VIEWS[t] for t in s.sources)} AS source_count,
    {_total(TABLE_VIEWS[t] for t in s.counted)} AS expected_count, {_total(_ITEM_VIEWS[n])} AS target_count"""
    for n, s in COLLECTIONS.items()
)
_RULE = """CASE WHEN source_count = 0 THEN target_count = 0 WHEN collection = 'employee_data' THEN target_count = source_count
    ELSE target_count > 0 AND target_count <= source_count END"""


@query(
    "reconcile_counts",
    sql(
        f"""SELECT collection, source_count, expected_count, target_count, {_RULE} AS valid, target_count = expected_count AS complete FROM n""",
        n=_COUNTS,
    ),
)
def reconcile_counts(spark, sf_dir):
    tables = store_tables(spark, sf_dir)
    return reconcile.reconcile_counts(COLLECTIONS, tables, build_all(tables, STAMP, lists=False))


def _verdicts(spark, sf_dir):
    """All collections, with faults in the customer profiles, one that does not exist, one unknown."""
    tables = store_tables(spark, sf_dir)
    collections: dict = build_all(tables, STAMP, lists=False)
    customers = collections["customer_data"]
    profiles = damaged(customers.filter("EntityType = 'CustomerProfile'"))
    collections["customer_data"] = profiles.unionByName(customers.filter("EntityType = 'Invoice'"))
    collections["playlist_data"] = None
    collections["ticket_data"] = None
    return reconcile.verdicts(spark, COLLECTIONS, tables, collections)


_VERDICTS = {
    "d": _DAMAGED_SQL,
    "f": f"{_KEY_SQL} UNION ALL {_REQUIRED_SQL} UNION ALL {_ENTITY_SQL}",
    "issue": "SELECT count(*) || ' items: ' || message AS issue FROM f GROUP BY \"check\", message",
    "n": _COUNTS,
    "v": """SELECT collection, collection <> 'customer_data' AS valid, source_count, target_count,
        CASE collection WHEN 'customer_data' THEN (SELECT string_agg(issue, '; ' ORDER BY issue) FROM issue) ELSE '' END AS issues
        FROM n WHERE collection <> 'playlist_data'
        UNION ALL SELECT 'playlist_data', false, 0, 0, 'Collection does not exist: playlist_data'
        UNION ALL SELECT 'ticket_data', false, 0, 0, 'Unknown collection: ticket_data'""",
    "t": """SELECT bool_and(valid) AS valid, CAST(sum(source_count) AS BIGINT) AS source_count,
        CAST(sum(target_count) AS BIGINT) AS target_count FROM v""",
}
_EFFICIENCY = """CASE WHEN source_count > 0 THEN CAST(target_count AS DOUBLE) / CAST(source_count AS DOUBLE) * CAST(100 AS DOUBLE) END AS efficiency"""


@query("validation_verdict", sql("SELECT * FROM v", **_VERDICTS))
def validation_verdict(spark, sf_dir):
    return _verdicts(spark, sf_dir).withColumn("issues", F.array_join("issues", "; "))


@query("validation_summary", sql(f"SELECT *, {_EFFICIENCY} FROM t", **_VERDICTS))
def validation_summary(spark, sf_dir):
    return reconcile.summary(_verdicts(spark, sf_dir))


@query(
    "validation_report",
    sql(
        f"""SELECT collection AS section, CASE WHEN valid THEN 'PASSED' ELSE 'FAILED' END AS status, source_count, target_count, issues, {_EFFICIENCY} FROM v
        UNION ALL SELECT 'SUMMARY', CASE WHEN valid THEN 'PASSED' ELSE 'FAILED' END, source_count, target_count, '', {_EFFICIENCY} FROM t""",
        **_VERDICTS,
    ),
)
def validation_report(spark, sf_dir):
    return reconcile.report(_verdicts(spark, sf_dir))
