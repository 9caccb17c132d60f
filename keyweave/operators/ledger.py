"""Load progress as an append-only event log, rolled up by aggregation.

Log columns: ``run_id``, ``seq`` (unique, growing), ``table_name``, ``event``, ``total``,
``migrated``, ``last_id``, ``message``, ``at``. Events of a table are ``initialized``, ``started``,
``progress``, ``completed`` and ``error``; ``paused`` and ``resumed`` belong to the run. Everything is
a partial aggregation per run and table, so a table with most of the events is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("migrated", T.LongType()),
        T.StructField("last_id", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)



def _zero() -> Column:
    return F.lit(0).cast("bigint")


def initial_events(counts: DataFrame, run_id: str, at: Column) -> DataFrame:
    """One ``initialized`` event per row of (``table_name``, ``record_count``)."""
    return counts.select(
        F.lit(run_id).alias("run_id"),
        _zero().alias("seq"),
        "table_name",
        F.lit("initialized").alias("event"),
        F.col("record_count").alias("total"),
        F.lit(None).cast("bigint").alias("migrated"),
        F.lit(None).cast("string").alias("last_id"),
        F.lit(None).cast("string").alias("message"),
        at.cast("timestamp_ntz").alias("at"),
    )


def ledger_start(counts: DataFrame) -> DataFrame:
    """State right after initialisation: every table not started, plus the totals of the run."""
    return counts.rollup("table_name").agg(
        F.sum("record_count").alias("total"), F.count(F.lit(1)).alias("tables"), F.grouping("table_name").alias("whole")
    ).select(
        F.when(F.col("whole") == 1, "RUN").otherwise(F.col("table_name")).alias("table_name"),
        F.lit("not_started").alias("status"),
        "total",
        _zero().alias("migrated"),
        "tables",
    )


def _newest(value: str, *events: str) -> Column:
    """Newest value that an event of the given kinds carries."""
    chosen = F.col("event").isin(*events) & F.col(value).isNotNull()
    return F.max_by(F.when(chosen, F.col(value)), F.when(chosen, F.col("seq")))


def _per_table(log: DataFrame) -> DataFrame:
    """All that is known per run and table; ``known`` is 0 for tables that were never initialised."""
    seen = log.groupBy("run_id", "table_name").agg(
        F.count_if(F.col("event") == "initialized").alias("known"),
        _newest("event", "initialized", "started", "completed", "error").alias("last_event"),
        F.coalesce(_newest("total", "initialized"), _zero()).alias("total"),
        F.coalesce(_newest("migrated", "progress"), _zero()).alias("counted"),
        _newest("last_id", "progress").alias("last_id"),
        F.count_if(F.col("event") == "error").alias("errors"),
        _newest("message", "error").alias("last_error"),
        _newest("at", "started").alias("started_at"),
        _newest("at", "completed").alias("completed_at"),
        _newest("event", "paused", "resumed").alias("switch"),
        F.max(F.when(F.col("event").isin("paused", "resumed"), F.col("seq"))).alias("switch_seq"),
        F.max("at").alias("last_at"),
    )
    status = (
        F.when(F.col("last_event") == "completed", "completed")
        .when(F.col("last_event") == "error", "failed")
        .when(F.col("last_event") == "started", "in_progress")
        .otherwise("not_started")
    )
    complete = F.col("status") == "completed"
    return seen.withColumn("status", status).withColumn(
        "migrated", F.when(complete, F.col("total")).otherwise(F.col("counted"))
    )


def table_progress(log: DataFrame) -> DataFrame:
    """Per run and table: status, totals, percent, errors, start, end and duration.

    Only initialised tables count. Completion sets migrated to the total and the progress to 100,
    also for an empty table; an error newer than the last start means ``failed``.
    """
    return _per_table(log).filter((F.col("known") > 0) & F.col("table_name").isNotNull()).select(
        "run_id",
        "table_name",
        "status",
        "total",
        "migrated",
        percent("migrated", "total", F.col("status") == "completed").alias("progress"),
        "errors",
        "last_error",
        "last_id",
        "started_at",
        "completed_at",
        F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")).alias("duration_us"),
    )


def percent(part: str, whole: str, complete: Column) -> Column:
    """Share in percent; 100 when complete, 0 for an empty whole."""
    share = F.col(part).cast("double") / F.col(whole).cast("double") * F.lit(100.0)
    return F.when(complete, F.lit(100.0)).when(F.col(whole) == 0, F.lit(0.0)).otherwise(share)


def run_progress(log: DataFrame) -> DataFrame:
    """Per run: status, tables, completed tables, records, percent and errors of any table."""
    known = F.col("known") > 0
    runs = _per_table(log).groupBy("run_id").agg(
        F.count_if(known).alias("total_tables"),
        F.count_if(known & (F.col("status") == "completed")).alias("completed_tables"),
        F.coalesce(F.sum(F.when(known, F.col("total"))), _zero()).alias("total"),
        F.coalesce(F.sum(F.when(known, F.col("migrated"))), _zero()).alias("migrated"),
        F.sum("errors").alias("errors"),
        F.max_by("switch", "switch_seq").alias("switch"),
        F.max("last_at").alias("last_checkpoint"),
    )
    complete = (F.col("total_tables") > 0) & (F.col("completed_tables") == F.col("total_tables"))
    status = F.when(complete, "completed").when(F.col("switch") == "paused", "paused").otherwise("in_progress")
    return runs.select(
        "run_id",
        status.alias("status"),
        "total_tables",
        "completed_tables",
        "total",
        "migrated",
        percent("migrated", "total", complete).alias("progress"),
        "errors",
        "last_checkpoint",
    )


def has_incomplete(log: DataFrame) -> DataFrame:
    """Runs that can be resumed."""
    return run_progress(log).filter(F.col("status") == "in_progress")


def resume_tables(log: DataFrame) -> DataFrame:
    """Tables still to be finished, with the last position; nothing for completed runs."""
    return table_progress(log).filter(F.col("status") != "completed").select(
        "run_id", "table_name", "status", "migrated", "total", "last_id"
    )


def resume_targets(log: DataFrame, mapping: DataFrame) -> DataFrame:
    """Collections fed by at least one unfinished table; ``mapping`` has (``table_name``, ``collection``)."""
    return resume_tables(log).join(mapping, "table_name").groupBy("run_id", "collection").agg(
        F.count(F.lit(1)).alias("unfinished_tables"), F.sum(F.col("total") - F.col("migrated")).alias("open_records")
    )


def errors(log: DataFrame, overall: str = "RUN") -> DataFrame:
    """Error count and newest message per table and for the run, unknown tables included in the run."""
    failures = log.filter(F.col("event") == "error")
    return failures.rollup("run_id", "table_name").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.max_by("message", "seq").alias("last_error"),
        F.grouping_id().alias("level"),
    ).filter(F.col("level") < 3).select(
        "run_id",
        F.when(F.col("level") == 1, overall).otherwise(F.col("table_name")).alias("table_name"),
        "error_count",
        "last_error",
    )


def throughput(batches: DataFrame, overall: str = "RUN") -> DataFrame:
    """Records, batches and records per second per table and run.

    ``batches`` has ``table_name``, ``records`` and ``at``. A span of zero gives rate 0.
    """
    span = F.timestamp_diff("MICROSECOND", F.min("at"), F.max("at"))
    seconds = F.col("span_us").cast("double") / F.lit(1e6)
    return batches.rollup("table_name").agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("batches"), span.alias("span_us"),
        F.grouping("table_name").alias("level"),
    ).select(
        F.when(F.col("level") == 1, overall).otherwise(F.col("table_name")).alias("table_name"),
        "records",
        "batches",
        "span_us",
        F.when(F.col("span_us") > 0, F.col("records").cast("double") / seconds).otherwise(F.lit(0.0)).alias("rate"),
    )


STATE_SCHEMA = "migration_id string, status string, total_records bigint, __corrupt string"


def check_states(states: DataFrame, text: str = "state") -> DataFrame:
    """Split saved states into readable and corrupt ones.

    Text that is no JSON ends in the corrupt column; JSON of another shape, or without id or status,
    parses to NULLs and is recognised by them.
    """
    parsed = states.withColumn(
        "__state",
        F.from_json(text, STATE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}),
    )
    unreadable = F.col("__state").isNull() | F.col("__state.__corrupt").isNotNull()
    incomplete = F.col("__state.migration_id").isNull() | F.col("__state.status").isNull()
    return parsed.withColumns(
        {
            "verdict": F.when(unreadable, "unreadable").when(incomplete, "incomplete").otherwise("valid"),
            "migration_id": F.col("__state.migration_id"),
            "status": F.col("__state.status"),
        }
    ).drop("__state")
