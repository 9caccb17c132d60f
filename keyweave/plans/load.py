"""Loads of collections that record their progress, and go on after a stop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from keyweave.operators import ledger
from keyweave.operators.upsert import KEYS, unwritten
from keyweave.sources.event_log import EventLog
from keyweave.sources.tables import CollectionStore

#: Items by the source table they come from.
Parts = Mapping[str, DataFrame]


class LoadFailed(RuntimeError):
    """A batch could not be written; the log has the error, and the load can be resumed."""


def slice_of(items: DataFrame, number: int, slices: int) -> DataFrame:
    """One of ``slices`` parts by the hash of the key: the same one in every attempt."""
    if slices == 1:
        return items
    return items.filter(F.pmod(F.xxhash64(F.lit(slices), *KEYS), F.lit(slices)) == number)


def load_collection(
    store: CollectionStore,
    log: EventLog,
    name: str,
    parts: Parts,
    slices: int = 1,
    force: bool = False,
    only_missing: bool = True,
    buckets: int | None = None,
) -> dict[str, str]:
    """Write a collection's items, table by table and slice by slice; returns what became of each table.

    A table the log has as completed is skipped, and so is a slice whose progress it has. With
    ``only_missing`` a slice writes only items whose key the collection does not hold yet, so a load that
    stopped between the write and the log repeats nothing. ``force`` writes all items of all tables again.
    Counts and the last key come from observations of the write itself, not from further jobs. A paused run
    does nothing.
    """
    if log.is_paused:
        return dict.fromkeys(parts, "paused")
    outcome = {}
    finished = {r["table_name"] for r in ledger.table_progress(log.read()).filter("status = 'completed'").collect()}
    for table, items in parts.items():
        if table in finished and not force:
            outcome[table] = "skipped"
            continue
        attempt = log.started(table)
        done = set() if force else log.done_batches(table)
        migrated = 0 if force else _migrated(log, table)
        for number in range(slices):
            if str(number) in done:
                continue
            try:
                found, last = _write(store, name, slice_of(items, number, slices), only_missing and not force, buckets)
            except Exception as e:  # whatever stops a write is an event of the run
                log.error(table, number, attempt, str(e).splitlines()[0][:1000])
                raise LoadFailed(f"{name}: slice {number} of {table}") from e
            migrated += found
            log.progress(table, number, migrated, last)
        log.completed(table, attempt)
        outcome[table] = "written"
    return outcome


def _migrated(log: EventLog, table: str) -> int:
    rows = ledger.table_progress(log.read()).filter(F.col("table_name") == table).select("migrated").collect()
    return rows[0][0] if rows else 0


def _write(
    store: CollectionStore, name: str, items: DataFrame, only_missing: bool, buckets: int | None
) -> tuple[int, str | None]:
    """Put one slice; returns how many items it has, written before or now, and its last key."""
    seen = Observation()
    key = F.concat_ws("|", *KEYS)
    watched = items.observe(seen, F.count(F.lit(1)).alias("items"), F.max(key).alias("last"))
    if not store.exists(name):
        store.create(name, watched, buckets=buckets)
    else:
        store.upsert(name, unwritten(watched, store.read(name).select(*KEYS)) if only_missing else watched)
    try:
        found = seen.get
    except Py4JError:
        # A slice that Spark finds empty while it runs is taken out of the plan, and its observation with it.
        if items.isEmpty():
            return 0, None
        raise
    return found["items"], found["last"]


def resume(
    store: CollectionStore,
    log: EventLog,
    collections: Mapping[str, Parts],
    slices: int = 1,
    only: Sequence[str] | None = None,
) -> dict[str, dict[str, str]]:
    """Go on with every collection that a table feeds which the log does not have as completed."""
    open_tables = {r["table_name"] for r in ledger.resume_tables(log.read()).select("table_name").collect()}
    wanted = [c for c, parts in collections.items() if open_tables & set(parts) and (only is None or c in only)]
    return {c: load_collection(store, log, c, collections[c], slices) for c in wanted}
