"""Relational file source: SQLite tables read in parallel by row-id ranges.

``spark.read.format("sqlite_table").option("path", ...).option("table", ...)``. ``path`` is a file or
a folder of files with the same table (shards); the files must lie where all executors can open
them. With ``spark.sql.python.filterPushdown.enabled`` comparison filters are evaluated in the file.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from keyweave.specs import ForeignKey, TableSpec

ROWS_PER_BATCH = 10_000

# Declared-type fragments and the affinity they stand for, in order of precedence.
AFFINITIES = (
    ("INT", T.LongType()),
    ("CHAR", T.StringType()),
    ("CLOB", T.StringType()),
    ("TEXT", T.StringType()),
    ("BLOB", T.BinaryType()),
    ("REAL", T.DoubleType()),
    ("FLOA", T.DoubleType()),
    ("DOUB", T.DoubleType()),
    ("NUMERIC", T.DoubleType()),
    ("DECIMAL", T.DoubleType()),
)

COMPARISONS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
}


def spark_type(declared: str) -> T.DataType:
    upper = (declared or "").upper()
    return next((dtype for part, dtype in AFFINITIES if part in upper), T.StringType())


def local_files(path: str) -> list[str]:
    plain = path[len("file:"):] if path.startswith("file:") else path
    while plain.startswith("//"):
        plain = plain[1:]
    return sorted(glob.glob(os.path.join(plain, "*.sqlite"))) if os.path.isdir(plain) else [plain]


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_names(path: str) -> list[str]:
    with connect(local_files(path)[0]) as db:
        rows = db.execute("SELECT name FROM sqlite_schema WHERE type = 'table' ORDER BY rowid").fetchall()
    return [name for (name,) in rows if not name.startswith("sqlite_")]


def discover(path: str) -> dict[str, TableSpec]:
    """Keys, foreign keys, plain indexes and defaults of all tables, as declared in the file."""
    specs = {}
    with connect(local_files(path)[0]) as db:
        described = {n: db.execute(f"PRAGMA table_info({quoted(n)})").fetchall() for n in table_names(path)}
        keys = {n: tuple(c[1] for c in sorted(cs, key=lambda c: c[5]) if c[5]) for n, cs in described.items()}
        for name, columns in described.items():
            links = db.execute(f"PRAGMA foreign_key_list({quoted(name)})").fetchall()
            indexes = db.execute(f"PRAGMA index_list({quoted(name)})").fetchall()
            specs[name] = TableSpec(
                name,
                keys[name],
                # A link without a named column goes to the key of the other table.
                tuple(ForeignKey(fk[3], fk[2], fk[4] or keys[fk[2]][fk[1]]) for fk in reversed(links)),
                tuple(i[1] for i in indexes if not i[2]),
                {c[1]: c[4] for c in columns if c[4] is not None},
            )
    return specs


@dataclass
class RowRange(InputPartition):
    path: str
    low: int | None
    high: int | None


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.table = options["table"]
        self.splits = int(options.get("partitions", "8"))
        self.conditions: list[tuple[str, list]] = []

    def partitions(self) -> list[RowRange]:
        """Row-id ranges of equal width per file; a table without row ids is read whole."""
        ranges = []
        files = local_files(self.path)
        per_file = max(1, self.splits // len(files))
        for path in files:
            with connect(path) as db:
                try:
                    low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
                except sqlite3.OperationalError:
                    ranges.append(RowRange(path, None, None))
                    continue
            if low is None:
                # Spark wants at least one partition, also of an empty table.
                ranges.append(RowRange(path, 0, -1))
                continue
            width = (high - low) // per_file + 1
            ranges += [RowRange(path, at, min(high, at + width - 1)) for at in range(low, high + 1, width)]
        return ranges

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema.fields]
        conditions, values = [c for c, _ in self.conditions], [v for _, vs in self.conditions for v in vs]
        if partition.low is not None:
            conditions.append("rowid BETWEEN ? AND ?")
            values += [partition.low, partition.high]
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in self.schema.fields])
        with connect(partition.path) as db:
            cursor = db.execute(f"SELECT {', '.join(map(quoted, names))} FROM {quoted(self.table)}{where}", values)
            while rows := cursor.fetchmany(ROWS_PER_BATCH):
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([convert(v, t) for v in c], t) for c, t in zip(columns, arrow.types)], schema=arrow
                )


class FilteringReader(SqliteReader):
    """Reader that hands filters to the file; Spark accepts it only with filter pushdown enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, IsNotNull) and len(f.attribute) == 1:
                self.conditions.append((f"{quoted(f.attribute[0])} IS NOT NULL", []))
            elif type(f) in COMPARISONS and len(f.attribute) == 1 and isinstance(f.value, (int, float)):
                self.conditions.append((f"{quoted(f.attribute[0])} {COMPARISONS[type(f)]} ?", [f.value]))
            else:
                yield f


def arrow_type(dtype: T.DataType) -> pa.DataType:
    if isinstance(dtype, T.LongType):
        return pa.int64()
    if isinstance(dtype, T.DoubleType):
        return pa.float64()
    return pa.binary() if isinstance(dtype, T.BinaryType) else pa.string()


def convert(value: object, dtype: pa.DataType) -> object:
    """Columns of the file are loosely typed: bring a stored value to the declared type."""
    if value is None:
        return None
    if pa.types.is_string(dtype):
        return value.decode() if isinstance(value, bytes) else str(value)
    if pa.types.is_int64(dtype):
        return int(value)
    if pa.types.is_float64(dtype):
        return float(value)
    return value.encode() if isinstance(value, str) else value


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> T.StructType:
        with connect(local_files(self.options["path"])[0]) as db:
            columns = db.execute(f"PRAGMA table_info({quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"No table {self.options['table']} in {self.options['path']}")
        return T.StructType([T.StructField(c[1], spark_type(c[2]), not (c[3] or c[5])) for c in columns])

    def reader(self, schema: T.StructType) -> SqliteReader:
        pushes = self.options.get("pushdown") == "true"
        return (FilteringReader if pushes else SqliteReader)(schema, dict(self.options))


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return (
        spark.read.format("sqlite_table")
        .option("path", path)
        .option("table", table)
        .option("partitions", str(partitions))
        .option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
        .load()
    )


def read_sqlite_store(spark: SparkSession, path: str, partitions: int = 8) -> dict[str, DataFrame]:
    """All tables of the file, each a lazy DataFrame."""
    return {name: read_sqlite(spark, path, name, partitions) for name in table_names(path)}
