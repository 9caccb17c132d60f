"""Versions of a keyed table, cut into buckets by the hash of its key.

A version is a manifest: for each bucket the write that holds it, and the schema. A put reads and
writes only the buckets its keys fall into and leaves all other files as they are; readers of an
earlier version are not disturbed. Two versions differ in the buckets whose write differs, so the
changes between them are found without a look at the others.

Layout: ``versions/<n>`` (manifests, written once) and ``data/<write>/bucket=<b>`` (Parquet).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.operators.joins import comparable_columns, frequent_keys
from keyweave.operators.upsert import latest
from keyweave.session import exceeds_partition, scratch_path, shuffle_partitions
from keyweave.sources.files import Files

BUCKET, SIDE = "__bucket", "__side"

# What a row does in a put; of one key the highest is kept.
STAYS, GONE, PUT = 0, 1, 2


class Conflict(RuntimeError):
    """Another writer made the next version first; the put can be repeated on that version."""


class Snapshots:
    """A bucketed table and its versions. Rows are unique by ``keys``; files are sorted by ``order``.

    The buckets come from the hash of the whole key, so a first key part shared by very many rows
    (a partition key, an index key) does not make one bucket larger than the others.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.order = tuple(order) or self.keys
        self._files = Files(spark, f"{self.path}/versions")
        self._manifests: dict[int, dict] = {}

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._files.names() if n.isdigit())

    def current(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version (the current one by default); a manifest never changes."""
        version = self.current() if version is None else version
        if version is None:
            raise ValueError(f"{self.path} has no version")
        if version not in self._manifests:
            self._manifests[version] = self._files.read_json(f"{version:010d}")
        return self._manifests[version]

    def schema(self, version: int | None = None) -> T.StructType:
        return _schema(self.manifest(version))

    def _commit(self, version: int, manifest: dict) -> int:
        if not self._files.write_json_once(f"{version:010d}", manifest):
            raise Conflict(f"version {version} of {self.path} exists already")
        return version

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def bucket_of(self, buckets: int, *key: object) -> int:
        """Bucket of one key; the optimizer folds the expression, no job runs."""
        values = F.xxhash64(*[F.lit(v) for v in key])
        return self.spark.range(1).select(F.pmod(values, F.lit(buckets)).cast("int")).first()[0]

    def _write(self, rows: DataFrame, buckets: int | None = None, order: Sequence[str] | None = None) -> tuple[str, set[int]]:
        """The row that comes last in ``order`` of each key, but those that take their key out, as one write;
        returns its name and the buckets it has.

        A bucket is one task. Rows are moved once, by bucket, and sorted once: the choice of the row and the
        files use the same order. Rows without a side are put.
        """
        name = uuid.uuid4().hex
        rows = rows if SIDE in rows.columns else rows.withColumn(SIDE, F.lit(PUT))
        buckets, order = buckets or shuffle_partitions(rows), self._order(rows) if order is None else order
        newest = latest(rows.repartitionById(buckets, BUCKET), order, (BUCKET, *self.keys))
        newest = newest.filter(F.col(SIDE) != GONE).drop(SIDE).sortWithinPartitions(BUCKET, *self.order)
        newest.withColumnRenamed(BUCKET, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{name}")
        found = Files(self.spark, f"{self.path}/data/{name}").names()
        return name, {int(n.removeprefix("bucket=")) for n in found if n.startswith("bucket=")}

    def _order(self, rows: DataFrame, version: Sequence[str] = ()) -> list[str]:
        """Which of several rows of a key is kept: by side, version, then all other columns."""
        others = [c for c in comparable_columns(rows) if c not in {*self.keys, *version, BUCKET, SIDE}]
        return [SIDE, *version, *others]

    def _incoming(self, rows: DataFrame, buckets: int, order: Sequence[str]) -> DataFrame:
        """Rows with their bucket, stored. Copies of a key that holds a large share of them do not go on."""
        kept = self._kept(rows.withColumns({BUCKET: self._bucket(buckets), SIDE: F.lit(PUT)}))
        if exceeds_partition(kept) and frequent_keys(kept, F.xxhash64(*self.keys)):
            return self._kept(latest(kept, order, (BUCKET, *self.keys)))
        return kept

    def create(self, rows: DataFrame, buckets: int | None = None, note: dict | None = None) -> int:
        """A version with exactly these rows; earlier versions stay readable."""
        buckets = buckets or shuffle_partitions(rows)
        order = self._order(rows)
        write, there = self._write(self._incoming(rows, buckets, order), buckets, order)
        parts = {str(b): write for b in sorted(there)}
        last = self.current()
        manifest = {"buckets": buckets, "schema": rows.schema.json(), "parts": parts, "note": note or {}}
        return self._commit(0 if last is None else last + 1, manifest)

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a version, or of some of its buckets. Columns a file does not have are NULL."""
        manifest = self.manifest(version)
        schema = _schema(manifest)
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [
            f"{self.path}/data/{write}/bucket={b}"
            for b, write in manifest["parts"].items()
            if wanted is None or b in wanted
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def get(self, *key: object, version: int | None = None) -> DataFrame:
        """The row of one key, read from its bucket only."""
        manifest = self.manifest(version)
        found = self.read(version, [self.bucket_of(manifest["buckets"], *key)])
        for name, value in zip(self.keys, key):
            found = found.filter(F.col(name) == value)
        return found

    def put(
        self,
        rows: DataFrame | None = None,
        removed: DataFrame | None = None,
        version: Sequence[str] = (),
        note: dict | None = None,
    ) -> int:
        """Put rows over those of equal key and take out the keys in ``removed``; returns the new version.

        A key in both is put. New columns are added; a column of another type is an error.
        """
        base = self.current()
        old = self.manifest(base)
        buckets, schema = old["buckets"], _schema(old)
        rows = self.spark.createDataFrame([], schema) if rows is None else rows
        schema = _merged(schema, rows.schema)
        order = self._order(rows, version)
        incoming = self._incoming(rows, buckets, order)
        gone = None
        there = incoming.select(BUCKET)
        if removed is not None:
            marks = {BUCKET: self._bucket(buckets), SIDE: F.lit(GONE)}
            gone = self._kept(removed.select(*self.keys).distinct().withColumns(marks))
            there = there.unionByName(gone.select(BUCKET))
        touched = [r[0] for r in there.distinct().collect()]  # as many as there are buckets at most
        parts = dict(old["parts"])
        if touched:
            content = self.read(base, touched).withColumns({BUCKET: self._bucket(buckets), SIDE: F.lit(STAYS)})
            for more in (incoming,) if gone is None else (incoming, gone):
                content = content.unionByName(more, allowMissingColumns=True)
            write, there = self._write(content.select(BUCKET, SIDE, *[f.name for f in schema]), buckets, order)
            for b in touched:
                parts.pop(str(b), None)
            parts |= {str(b): write for b in there}
        manifest = {"buckets": buckets, "schema": schema.json(), "parts": parts, "note": note or {}}
        return self._commit(base + 1, manifest)

    def _kept(self, rows: DataFrame) -> DataFrame:
        """Rows that several steps read, stored once in the shared folder."""
        path = scratch_path(self.spark, "puts")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def changes(self, before: int, after: int) -> DataFrame:
        """Keys whose row differs between two versions: the keys, ``old`` and ``new`` (structs, NULL if absent).

        Only buckets with another write are read.
        """
        first, last = self.manifest(before), self.manifest(after)
        if first["buckets"] != last["buckets"]:
            differ = None
        else:
            differ = [b for b in range(first["buckets"]) if first["parts"].get(str(b)) != last["parts"].get(str(b))]
        schema = _merged(_schema(first), _schema(last))
        names = [f.name for f in schema]

        def side(version: int, name: str) -> DataFrame:
            rows = self.read(version, differ)
            missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in rows.columns}
            rows = rows.withColumns(missing) if missing else rows
            return rows.select(*[F.col(k).alias(f"{name}_{k}") for k in self.keys], F.struct(*names).alias(name))

        old, new = side(before, "old"), side(after, "new")
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}"))
        joined = old.join(new, same, "full_outer")
        return joined.filter(~_text("old").eqNullSafe(_text("new"))).select(
            *[F.coalesce(f"new_{k}", f"old_{k}").alias(k) for k in self.keys], "old", "new"
        )

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all versions but the last ``keep`` and the writes that none of these uses; returns these writes."""
        if keep < 1:
            raise ValueError("the current version stays")
        versions = self.versions()
        kept = {w for v in versions[-keep:] for w in self.manifest(v)["parts"].values()}
        for v in versions[:-keep]:
            self._files.remove(f"{v:010d}")
            self._manifests.pop(v, None)
        data = Files(self.spark, f"{self.path}/data")
        gone = [w for w in data.names() if w not in kept]
        for write in gone:
            data.remove(write)
        return gone


def _schema(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(manifest["schema"]))


def _text(struct: str) -> Column:
    """A struct as text that can be compared, also with maps inside; NULL for an absent row."""
    return F.when(F.col(struct).isNotNull(), F.to_json(struct, {"ignoreNullFields": "false"}))


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise AnalysisException(f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType(
        [T.StructField(f.name, f.dataType) for f in old] + [T.StructField(f.name, f.dataType) for f in new if f.name not in known]
    )
