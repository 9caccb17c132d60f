"""Incremental load: new source files become a delta of items, and readers see the latest of each key.

The streaming checkpoint decides what is new. Each micro-batch writes one folder named by its batch
id in overwrite mode, so a batch that is replayed after a failure replaces itself. A load costs only
its own data; ``compact`` folds the deltas together from time to time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from keyweave.operators.joins import comparable_columns
from keyweave.operators.upsert import KEYS, latest
from keyweave.sources.files import Files
from keyweave.sources.snapshots import Snapshots


class DeltaLog:
    """Batches of items under one folder: ``writes/batch=N`` per load, and ``base/upto=N`` for a fold.

    A base holds all batches up to N. It has its own place, so a batch that the stream repeats after the
    fold cannot overwrite it: such a batch is known to be in the base and is not written again.
    """

    def __init__(self, spark: SparkSession, path: str, version: Sequence[str] = (), keys: Sequence[str] = KEYS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.version = tuple(version)
        self.keys = tuple(keys)

    def _latest(self, df: DataFrame) -> DataFrame:
        order = [*self.version, *[c for c in comparable_columns(df) if c not in {*self.keys, *self.version, "batch"}]]
        return latest(df, ["batch", *order] if "batch" in df.columns else order, self.keys)

    def _folders(self, below: str, prefix: str) -> list[int]:
        return sorted(int(n.removeprefix(prefix)) for n in Files(self.spark, self.path).names(below) if n.startswith(prefix))

    def _part(self, folders: list[str]) -> DataFrame | None:
        """Folders in the schema that all their writes together have. It is noted with each write, so no footer is read for it."""
        if not folders:
            return None
        notes = Files(self.spark, f"{self.path}/schemas")
        schema = T.StructType()
        for name in notes.names():
            known = set(schema.names)
            schema = T.StructType([*schema, *[f for f in T.StructType.fromJson(notes.read_json(name)) if f.name not in known]])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _write(self, items: DataFrame, folder: str) -> None:
        note = items.schema.jsonValue()
        digest = hashlib.sha256(json.dumps(note).encode()).hexdigest()[:16]
        Files(self.spark, f"{self.path}/schemas").write_json_once(digest, note)
        items.write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def upto(self) -> int:
        """The last batch that the base holds; -1 without a base."""
        return max(self._folders("base", "upto="), default=-1)

    def append(self, items: DataFrame, batch: int) -> bool:
        """Write one batch, reduced to one item per key; writing it again replaces it.

        False if the batch is part of the base already, so nothing was written.
        """
        if batch <= self.upto():
            return False
        self._write(self._latest(items), f"writes/batch={batch}")
        return True

    def all_writes(self) -> DataFrame:
        """The base (as one batch) and every batch after it."""
        upto = self.upto()
        parts = []
        base = self._part([f"base/upto={upto}"] if upto >= 0 else [])
        if base is not None:
            parts.append(base.withColumn("batch", F.lit(upto)))
        for batch in self._folders("writes", "batch="):
            if batch > upto:
                parts.append(self._part([f"writes/batch={batch}"]).withColumn("batch", F.lit(batch)))
        if not parts:
            raise ValueError(f"no batch has been written to {self.path}")
        return reduce(DataFrame.unionByName, parts)

    def read(self) -> DataFrame:
        """The collection: the newest write of each key."""
        return self._latest(self.all_writes()).drop("batch")

    def compact(self, target: str) -> DeltaLog:
        """Fold all batches into a base in a new folder; the old log stays untouched for its readers."""
        newest = max([self.upto(), *self._folders("writes", "batch=")])
        folded = DeltaLog(self.spark, target, self.version, self.keys)
        folded._write(self.read(), f"base/upto={newest}")
        return folded


class PutLog:
    """Batches put straight into the versions of a bucketed table.

    A batch writes the buckets its keys fall into and notes its number with the version, so a batch that the
    stream repeats is known and not put again. A reader opens the current version: no window over all writes, no fold.
    Cheaper to read than a ``DeltaLog``, dearer to write where a batch touches nearly all buckets.
    """

    def __init__(
        self, spark: SparkSession, path: str, version: Sequence[str] = (), keys: Sequence[str] = KEYS, buckets: int | None = None
    ):
        self.table = Snapshots(spark, path, keys)
        self.version = tuple(version)
        self.buckets = buckets

    def upto(self) -> int:
        """The last batch that was put; -1 before the first."""
        return -1 if self.table.current() is None else self.table.manifest()["note"]["batch"]

    def append(self, items: DataFrame, batch: int) -> bool:
        """Put one batch over the earlier ones; False if it, or a later one, is there already."""
        if batch <= self.upto():
            return False
        if self.table.current() is None:
            order = [*self.version, *[c for c in comparable_columns(items) if c not in {*self.table.keys, *self.version}]]
            self.table.create(latest(items, order, self.table.keys), self.buckets, {"batch": batch})
        else:
            self.table.put(items, version=self.version, note={"batch": batch})
        return True

    def read(self) -> DataFrame:
        if self.table.current() is None:
            raise ValueError(f"no batch has been put into {self.table.path}")
        return self.table.read()


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    log: DeltaLog | PutLog,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Process all files that came since the last call, then stop. Returns the rows read by the batches written."""
    counts: dict[int, int] = {}

    def write(rows: DataFrame, batch: int) -> None:
        seen = Observation()
        if log.append(transform(rows.observe(seen, F.count(F.lit(1)).alias("rows"))), batch):
            counts[batch] = seen.get["rows"]

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(counts.values())
