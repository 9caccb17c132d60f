"""Batched key-value sink with bounded retries, as a Spark data source.

``df.write.format("keyed_batches").mode("append")`` sends the ``item`` column (encoded items, see
``functions.codec``) in batches of at most 25 through a client, named by the option ``client`` as
``module:factory``. A client has ``put(table, items) -> items not taken`` and may raise
``Throttled``. Puts replace by key, so a batch sent again by a retried task does no harm.

Each task sends its own rows as they stream by. Items left over after all retries go, one file per batch,
to the ``dead_letters`` folder; the driver receives only counts per task.
"""

from __future__ import annotations

import importlib
import io
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from keyweave.functions.codec import decode_items
from keyweave.operators.upsert import KEYS, latest

# Batch bound, number of retries, first waits in seconds (each retry doubles them).
MAX_BATCH = 25
MAX_RETRIES = 3
UNPROCESSED_WAIT = 0.1
THROTTLE_WAIT = 0.5


class Throttled(Exception):
    """Raised by a client when the store asks for a slower pace."""


class StoreError(Exception):
    """Raised by a client for any other refusal; tried again at once."""


@dataclass
class TaskResult(WriterCommitMessage):
    written: int
    unprocessed: int
    batches: int
    retries: int


class FolderClient:
    """Client that keeps its puts below a folder, one file for each table that it puts to; for tests and dry runs.

    A line is an item, a tab (JSON text has none) and the time of its put. A batch is one unbuffered write at the
    end of the file, so there are as many files as tasks and not as batches.
    """

    def __init__(self, folder: str):
        self.folder = local_folder(folder)
        self.files: dict[str, io.FileIO] = {}

    def put(self, table: str, items: list[str]) -> list[str]:
        if table not in self.files:
            folder = os.path.join(self.folder, table)
            os.makedirs(folder, exist_ok=True)
            self.files[table] = open(os.path.join(folder, f"{uuid.uuid4().hex}.json"), "ab", buffering=0)
        end = f"\t{time.time_ns()}\n"
        lines = (end.join(items) + end).encode()
        while lines:  # an unbuffered write may take a part only
            lines = lines[self.files[table].write(lines):]
        return []


class DynamoClient:
    """Client for a DynamoDB table; needs the boto3 package on the executors."""

    def __init__(self, region: str):
        import boto3

        self.client = boto3.client("dynamodb", region_name=region)

    def put(self, table: str, items: list[str]) -> list[str]:
        from botocore.exceptions import ClientError

        request = {table: [{"PutRequest": {"Item": json.loads(i)}} for i in items]}
        try:
            left = self.client.batch_write_item(RequestItems=request).get("UnprocessedItems", {})
        except ClientError as error:
            throttled = error.response["Error"]["Code"] in (
                "ProvisionedThroughputExceededException",
                "ThrottlingException",
            )
            raise (Throttled if throttled else StoreError)(str(error)) from error
        # Leftovers come back encoded and are handed on as they are, never encoded twice.
        return [json.dumps(r["PutRequest"]["Item"]) for r in left.get(table, [])]


def write_lines(folder: str, lines: list[str]) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{uuid.uuid4().hex}.json"), "w") as f:
        f.writelines(line + "\n" for line in lines)


def local_folder(path: str) -> str:
    plain = path[len("file:"):] if path.startswith("file:") else path
    while plain.startswith("//"):
        plain = plain[1:]
    return plain


def chunks(rows: Iterator[str], size: int) -> Iterator[list[str]]:
    chunk: list[str] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def put_batch(
    put: Callable[[str, list[str]], list[str]],
    table: str,
    items: list[str],
    retries: int = MAX_RETRIES,
    wait: Callable[[float], None] = time.sleep,
) -> tuple[list[str], int]:
    """Send one batch; returns the items never taken and the number of retries."""
    open_items, attempt = list(items), 0
    while True:
        pause = 0.0
        try:
            open_items = put(table, open_items)
            pause = UNPROCESSED_WAIT * 2**attempt
        except Throttled:
            pause = THROTTLE_WAIT * 2**attempt
        except StoreError:
            pause = 0.0
        if not open_items or attempt == retries:
            return open_items, attempt
        if pause:
            wait(pause)
        attempt += 1


def make_client(options: dict[str, str]):
    module, _, factory = options["client"].partition(":")
    return getattr(importlib.import_module(module), factory)(options.get("client_argument", ""))


class BatchWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def write(self, iterator: Iterator[Row]) -> TaskResult:
        return self.send(row["item"] for row in iterator)

    def send(self, items: Iterator[str]) -> TaskResult:
        options = self.options
        table = options["table"]
        size = min(MAX_BATCH, int(options.get("batch_size", MAX_BATCH)))
        retries = int(options.get("max_retries", MAX_RETRIES))
        factory = {"folder": FolderClient, "dynamo": DynamoClient}.get(options.get("client", "folder"))
        client = factory(options.get("client_argument", "")) if factory else make_client(options)
        result = TaskResult(0, 0, 0, 0)
        for batch in chunks(items, size):
            left, tried = put_batch(client.put, table, batch, retries)
            # What a batch could not place gets one more chance item by item.
            left = [i for one in left for i in put_batch(client.put, table, [one], retries)[0]]
            if left:
                write_lines(local_folder(options["dead_letters"]), left)
            result.written += len(batch) - len(left)
            result.unprocessed += len(left)
            result.batches += 1
            result.retries += tried
        return result

    def commit(self, messages: list[TaskResult | None]) -> None:
        done = [m for m in messages if m is not None]
        totals = {k: sum(getattr(m, k) for m in done) for k in ("written", "unprocessed", "batches", "retries")}
        if "summary" in self.options:
            write_lines(local_folder(self.options["summary"]), [json.dumps({"collection": self.options["table"], **totals})])


class ArrowBatchWriter(DataSourceArrowWriter, BatchWriter):
    """Takes the items out of record batches, without a row object for each."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskResult:
        return self.send(item for batch in iterator for item in batch.column("item").to_pylist())


class KeyedBatchSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_batches"

    def writer(self, schema: StructType, overwrite: bool) -> ArrowBatchWriter:
        return ArrowBatchWriter(dict(self.options))


def put_items(encoded: DataFrame, table: str, folder: str, client: str = "folder", argument: str | None = None,
              batch_size: int = MAX_BATCH, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Write the ``item`` column and return the sink's one-row summary.

    ``folder`` (in the shared file system) takes the summary and the dead letters, and the items
    themselves with the folder client.
    """
    spark: SparkSession = encoded.sparkSession
    spark.dataSource.register(KeyedBatchSink)
    (
        encoded.select("item")
        .write.format("keyed_batches")
        .mode("append")
        .option("table", table)
        .option("client", client)
        .option("client_argument", argument if argument is not None else f"{folder}/items")
        .option("batch_size", str(batch_size))
        .option("max_retries", str(max_retries))
        .option("dead_letters", f"{folder}/dead")
        .option("summary", f"{folder}/summary")
        .save()
    )
    return spark.read.schema(
        "collection string, written bigint, unprocessed bigint, batches bigint, retries bigint"
    ).json(f"{folder}/summary")


def read_put_items(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The encoded items that the folder client holds: the last put of each key, since a repeated
    task puts its items again. A line that a stopped task left without its time is no put."""
    lines = spark.read.text(f"{folder}/items/{table}").filter(F.col("value").rlike(r"\t[0-9]{19}$"))
    puts = lines.select(
        F.substring_index("value", "\t", 1).alias("item"), F.substring_index("value", "\t", -1).cast("bigint").alias("at")
    )
    keys = StructType([StructField(k, StringType()) for k in KEYS])
    # Few keys are put twice: rows are moved once and sorted once, not reduced before that.
    placed = decode_items(puts, keys, keep=("item", "at")).repartition(*KEYS)
    return latest(placed, ["at", "item"]).select("item")
