"""The progress log of loads, written event by event and read as a DataFrame (see ``operators.ledger``).

An event is one small file, named by what it tells: run, table, event and batch. It is written whole or not
at all and never again, so a load that repeats a batch adds nothing, and a reader sees every event once.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.ledger import LOG_SCHEMA
from keyweave.sources.files import Files


def _quoted(value: object) -> str:
    return quote(str(value), safe="").replace(".", "%2E")


class EventLog:
    """Events of one run below ``path``; one driver writes a run, any number may read it."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.run_id = run_id
        self._files = Files(spark, f"{self.path}/{_quoted(run_id)}")
        self._last = 0

    def _write(self, event: str, batch: object, table: str | None = None, **values: object) -> bool:
        """Append one event; False if this run has it already."""
        # The event stands first: a name that begins with a dot or an underscore would be hidden from readers.
        name = ".".join(map(_quoted, (event, table or "", batch))) + ".json"
        self._last = max(self._last + 1, time.time_ns() // 1000)  # grows, also within a microsecond
        at = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
        row = {"run_id": self.run_id, "seq": self._last, "table_name": table, "event": event, "at": at}
        return self._files.write_json_once(name, row | {k: v for k, v in values.items() if v is not None})

    def initialize(self, counts: DataFrame) -> None:
        """Every table of (``table_name``, ``record_count``) as not started; a table is initialised once."""
        for row in counts.collect():  # one row per source table
            self._write("initialized", 0, row["table_name"], total=row["record_count"])

    def attempts(self, table: str) -> int:
        return sum(p[:2] == ["started", _quoted(table)] for p in map(self._parts, self._files.names()))

    @staticmethod
    def _parts(name: str) -> list[str]:
        return name.removesuffix(".json").split(".")

    def done_batches(self, table: str) -> set[str]:
        """Batches of a table whose progress is written."""
        return {p[2] for p in map(self._parts, self._files.names()) if p[:2] == ["progress", _quoted(table)]}

    def started(self, table: str) -> int:
        """Begin an attempt on a table; returns its number."""
        attempt = self.attempts(table) + 1
        self._write("started", attempt, table)
        return attempt

    def progress(self, table: str, batch: object, migrated: int, last_id: str | None = None) -> bool:
        return self._write("progress", batch, table, migrated=migrated, last_id=last_id)

    def completed(self, table: str, attempt: int = 1) -> bool:
        return self._write("completed", attempt, table)

    def error(self, table: str, batch: object, attempt: int, message: str) -> bool:
        return self._write("error", f"{batch}-{attempt}", table, message=message)

    def _switch(self, event: str) -> bool:
        """``paused`` and ``resumed`` take turns; the same one twice in a row is written once."""
        turns = self._turns()
        return (turns % 2 == 0) == (event == "paused") and self._write(event, turns)

    def pause(self) -> bool:
        return self._switch("paused")

    def resume(self) -> bool:
        return self._switch("resumed")

    @property
    def is_paused(self) -> bool:
        return self._turns() % 2 == 1

    def _turns(self) -> int:
        return sum(self._parts(n)[0] in ("paused", "resumed") for n in self._files.names())

    def read(self, all_runs: bool = False) -> DataFrame:
        """The events, for the rollups of ``operators.ledger``."""
        if not self._files.names() and not all_runs:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        events = self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(self.path)
        return events if all_runs else events.filter(F.col("run_id") == self.run_id)
