"""Put semantics: one item per key, the latest write replaces the earlier one as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.operators.joins import comparable_columns, keyed_join, one_row_per_key
from keyweave.session import scratch_path

KEYS = ("PK", "SK")


def latest(df: DataFrame, version: Sequence[Column | str], keys: Sequence[str] = KEYS) -> DataFrame:
    """The row of highest ``version`` per key. Superseded rows are dropped before the shuffle."""
    order = [(F.col(v) if isinstance(v, str) else v).desc_nulls_last() for v in version]
    return one_row_per_key(df, list(keys), order)


def keyed_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS, version: Sequence[str] = ()
) -> DataFrame:
    """``existing`` with ``incoming`` put into it.

    Incoming items win over existing ones; among several items of one side the highest ``version``
    wins, and without versions the highest value of the whole item, so the result is repeatable.
    """
    both = existing.withColumn("__batch", F.lit(0)).unionByName(
        incoming.withColumn("__batch", F.lit(1)), allowMissingColumns=True
    )
    order = ["__batch", *version, *[c for c in comparable_columns(both) if c not in {*keys, *version, "__batch"}]]
    return latest(both, order, keys).drop("__batch")


def not_yet_written(items: DataFrame, written: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Items whose key is not among those already written."""
    done = written.select(F.struct(*keys).alias("__done")).distinct()
    return keyed_join(items, done, F.struct(*keys), "__done", "left_anti")


#: Bits of the map of written keys: 8 MB at most, in rows of 4 KB.
KEY_BITS = 1 << 26


def key_bits(written: DataFrame, keys: Sequence[str] = KEYS, bits: int = KEY_BITS) -> DataFrame:
    """A bit per hash value of the written keys: rows of (``__word``, ``__bits``), at most ``bits`` / 32768 of them."""
    at = _bit_place(keys, bits)
    return written.groupBy(F.bitmap_bucket_number(at).alias("__word")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits")
    )


def _bit_place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def marked(items: DataFrame, bitmap: DataFrame, keys: Sequence[str] = KEYS, bits: int = KEY_BITS) -> DataFrame:
    """Items with ``__maybe``: false means that no written key has the item's hash, so its key is not written."""
    at = _bit_place(keys, bits)
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    is_set = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    # The bitmap has a fixed size, whatever was written.
    met = items.join(F.broadcast(bitmap), F.bitmap_bucket_number(at) == F.col("__word"), "left")
    return met.withColumn("__maybe", is_set).drop("__word", "__bits")


def unwritten(items: DataFrame, written: DataFrame, keys: Sequence[str] = KEYS, bits: int = KEY_BITS) -> DataFrame:
    """Items whose key is not among those already written, for items and keys of any number.

    The bitmap lets items of new keys pass without a join; only the others meet the written keys. The
    marked items are stored once, as both ways read them.
    """
    spark = items.sparkSession
    path = scratch_path(spark, "marked")
    marked(items, key_bits(written, keys, bits), keys, bits).write.partitionBy("__maybe").parquet(path)
    stored = spark.read.schema(T.StructType([*items.schema, T.StructField("__maybe", T.BooleanType())])).parquet(path)
    sure, maybe = (stored.filter(F.col("__maybe") == m).drop("__maybe") for m in (False, True))
    return sure.unionByName(not_yet_written(maybe, written, keys))
