from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keyweave.operators import ledger

START = datetime(2024, 1, 1)


def log(spark, *events):
    """Events as (table, event, total, migrated, last_id, message); seq and time follow the order."""
    rows = [("r", i, *e, START + timedelta(seconds=i)) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, ledger.LOG_SCHEMA)


def init(table, total):
    return (table, "initialized", total, None, None, None)


def start(table):
    return (table, "started", None, None, None, None)


def moved(table, n, last=None):
    return (table, "progress", None, n, last, None)


def done(table):
    return (table, "completed", None, None, None, None)


def failed(table, message):
    return (table, "error", None, None, None, message)


def tables(df):
    return {r["table_name"]: r for r in ledger.table_progress(df).collect()}


def test_table_states(spark):
    found = tables(
        log(
            spark,
            *[init(t, 100) for t in "abcde"],
            init("empty", 0),
            start("a"), moved("a", 40, "40"), moved("a", 60), start("b"), moved("b", 99, "99"), done("b"),
            start("c"), failed("c", "one"), failed("c", "two"), start("d"), failed("d", "x"), start("d"), start("empty"), done("empty"),
            start("stranger"), failed("stranger", "lost"),
        )
    )
    assert {t: (r["status"], r["migrated"], r["progress"]) for t, r in found.items()} == {
        "a": ("in_progress", 60, 60.0), "b": ("completed", 100, 100.0), "c": ("failed", 0, 0.0), "d": ("in_progress", 0, 0.0),
        "e": ("not_started", 0, 0.0), "empty": ("completed", 0, 100.0),
    }
    assert found["a"]["last_id"] == "40" and found["c"]["errors"] == 2 and found["c"]["last_error"] == "two"
    assert found["b"]["duration_us"] == 2_000_000 and found["a"]["duration_us"] is None


def test_run_state(spark):
    events = [init("a", 30), init("b", 10), start("a"), moved("a", 10), failed("elsewhere", "lost")]
    run = ledger.run_progress(log(spark, *events)).first()
    assert (run["status"], run["total"], run["migrated"], run["progress"], run["errors"]) == ("in_progress", 40, 10, 25.0, 1)
    paused = [*events, (None, "paused", None, None, None, None)]
    assert ledger.run_progress(log(spark, *paused)).first()["status"] == "paused"
    resumed = [*paused, (None, "resumed", None, None, None, None)]
    assert ledger.run_progress(log(spark, *resumed)).first()["status"] == "in_progress"
    assert ledger.has_incomplete(log(spark, *resumed)).count() == 1
    complete = ledger.run_progress(log(spark, *events, done("a"), done("b"))).first()
    assert (complete["status"], complete["completed_tables"], complete["migrated"], complete["progress"]) == ("completed", 2, 40, 100.0)
    assert ledger.has_incomplete(log(spark, *events, done("a"), done("b"))).count() == 0


def test_resume(spark):
    df = log(spark, init("Artist", 5), init("Album", 7), init("Customer", 3), start("Artist"), done("Artist"), start("Album"), moved("Album", 4, "4"))
    open_tables = {r["table_name"]: (r["status"], r["migrated"], r["last_id"]) for r in ledger.resume_tables(df).collect()}
    assert open_tables == {"Album": ("in_progress", 4, "4"), "Customer": ("not_started", 0, None)}
    mapping = spark.createDataFrame(
        [("Artist", "music"), ("Album", "music"), ("Customer", "customers"), ("Employee", "employees")], "table_name string, collection string"
    )
    targets = {r["collection"]: (r["unfinished_tables"], r["open_records"]) for r in ledger.resume_targets(df, mapping).collect()}
    assert targets == {"music": (1, 3), "customers": (1, 3)}


@pytest.mark.parametrize("counts, total", [([20, 50, 100], 170), ([5000, 10000, 30000], 45000), ([1], 1), ([0], 0)])
def test_ledger_start(spark, counts, total):
    df = spark.createDataFrame([(f"t{i}", n) for i, n in enumerate(counts)], "table_name string, record_count bigint")
    found = {r["table_name"]: r for r in ledger.ledger_start(df).collect()}
    assert found["RUN"]["total"] == total and found["RUN"]["tables"] == len(counts)
    events = ledger.initial_events(df, "r", F.lit("2024-01-01 00:00:00"))
    run = ledger.run_progress(events).first()
    assert (run["total"], run["migrated"], run["status"]) == (total, 0, "in_progress")


def test_errors(spark):
    df = log(spark, failed("a", "one"), failed("b", "two"), failed("a", "three"), init("a", 1))
    found = {r["table_name"]: (r["error_count"], r["last_error"]) for r in ledger.errors(df).collect()}
    assert found == {"a": (2, "three"), "b": (1, "two"), "RUN": (3, "three")}


def test_throughput(spark):
    rows = [("a", 10, START), ("a", 30, START + timedelta(seconds=4)), ("b", 5, START)]
    df = spark.createDataFrame(rows, "table_name string, records bigint, at timestamp_ntz")
    found = {r["table_name"]: (r["records"], r["batches"], r["rate"]) for r in ledger.throughput(df).collect()}
    assert found == {"a": (40, 2, 10.0), "b": (5, 1, 0.0), "RUN": (45, 3, 11.25)}


@pytest.mark.parametrize(
    "text, verdict",
    [
        ('{"status": "paused", "migration_id": "run-9", "tables": []}', "valid"),
        ('{"migration_id": "run-9", "sta', "unreadable"),
        ("run-9;paused", "unreadable"),
        ('{"status": "paused"}', "incomplete"),
        ('{"migration_id": "run-9"}', "incomplete"),
        (None, "unreadable"),
    ],
)
def test_corrupt_states(spark, text, verdict):
    df = spark.createDataFrame([(text,)], "state string")
    assert ledger.check_states(df).first()["verdict"] == verdict
