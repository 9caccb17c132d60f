"""Profile of a stored table that is kept with its versions.

Counts and distinct sketches are stored per write and bucket. A version's profile unites the parts that its
manifest names, so after a put only the write of that put is read, and rows that were replaced or removed
are gone from the counts and from the sketches alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.sources.files import Files
from keyweave.sources.snapshots import Snapshots

#: log2 of a sketch's registers: a relative standard error of about 1.04 / sqrt(2 ** LG_K), 1.6 %.
LG_K = 12

_PART = "bucket int, column_name string, rows bigint, present bigint, least string, greatest string, sketch binary"


def _countable(column: str, dtype: T.DataType) -> Column:
    c = F.col(f"`{column}`")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    if isinstance(dtype, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(F.struct(c))
    return c.cast("string")


def _part_rows(rows: DataFrame) -> DataFrame:
    """One row per bucket and column of a write."""
    fields = [f for f in rows.schema if f.name != "bucket"]
    stats = [F.count(F.lit(1)).alias("rows")]
    for n, f in enumerate(fields):
        value = _countable(f.name, f.dataType)
        plain = isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)
        text = F.col(f"`{f.name}`") if plain else F.lit(None).cast("string")
        stats += [
            F.count(F.col(f"`{f.name}`")).alias(f"present{n}"),
            F.min(text).cast("string").alias(f"least{n}"),
            F.max(text).cast("string").alias(f"greatest{n}"),
            F.hll_sketch_agg(value, F.lit(LG_K)).alias(f"sketch{n}"),
        ]
    one = rows.groupBy("bucket").agg(*stats)
    cells = [
        F.struct(F.lit(f.name).alias("column_name"), *[F.col(f"{c}{n}").alias(c) for c in ("present", "least", "greatest", "sketch")])
        for n, f in enumerate(fields)
    ]
    return one.select("bucket", "rows", F.explode(F.array(*cells)).alias("cell")).select("bucket", "cell.column_name", "rows", "cell.present", "cell.least", "cell.greatest", "cell.sketch")


def _profiled(store: Snapshots, write: str) -> str:
    """Folder of a write's parts; made on first use, from the files of that write only."""
    path = f"{store.path}/profiles/{write}"
    if "_SUCCESS" not in Files(store.spark, path).names():
        _part_rows(store.spark.read.parquet(f"{store.path}/data/{write}")).write.mode("overwrite").parquet(path)
    return path


def kept_profile(store: Snapshots, version: int | None = None) -> DataFrame:
    """Per column of a version: ``row_count``, ``null_count`` and an estimate ``distinct_count``.

    A column that a file does not have is NULL in all its rows.
    """
    manifest = store.manifest(version)
    columns = [f.name for f in store.schema(version)]
    spark = store.spark
    zero = F.lit(0).cast("bigint")
    names = spark.createDataFrame([(c,) for c in columns], "column_name string")
    if not manifest["parts"]:
        return names.select("column_name", *[zero.alias(c) for c in ("row_count", "null_count", "distinct_count")])
    used: dict[str, list[int]] = {}
    for bucket, write in manifest["parts"].items():
        used.setdefault(write, []).append(int(bucket))
    parts = None
    for write, buckets in used.items():
        part = spark.read.schema(_PART).parquet(_profiled(store, write)).filter(F.col("bucket").isin(buckets))
        parts = part if parts is None else parts.unionByName(part)
    # Every part has the first key column, so its counts tell the rows of the version.
    total = parts.filter(F.col("column_name") == store.keys[0]).agg(F.sum("rows")).scalar()
    united = parts.groupBy("column_name").agg(
        F.sum("present").alias("present"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count")
    )
    return names.join(united, "column_name", "left").select(
        "column_name",
        total.alias("row_count"),
        (total - F.coalesce("present", zero)).alias("null_count"),
        F.coalesce("distinct_count", zero).alias("distinct_count"),
    )
