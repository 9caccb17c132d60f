"""Access patterns on item collections: get, partition, prefix and index queries, search, scan, count.

Every pattern is a filter or a keyed join, so on a stored collection (range-sorted by key, see
``index_layout``) the parquet statistics skip the row groups that cannot match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.operators.joins import keyed_join
from keyweave.operators.ordering import page
from keyweave.session import shuffle_partitions
from keyweave.specs import IndexSpec


def get_item(items: DataFrame, pk: str, sk: str) -> DataFrame:
    return items.filter((F.col("PK") == pk) & (F.col("SK") == sk))


def get_items(items: DataFrame, keys: DataFrame) -> DataFrame:
    """Items of all (PK, SK) pairs in ``keys``. Both sides hold a pair once, so no pair can be hot."""
    return items.join(keys.select("PK", "SK").distinct(), ["PK", "SK"], "left_semi")


def query_partition(items: DataFrame, pk: str, prefix: str | None = None) -> DataFrame:
    """Items of one partition in sort-key order, optionally only those whose sort key has the prefix."""
    found = items.filter(F.col("PK") == pk)
    if prefix is not None:
        found = found.filter(F.col("SK").startswith(prefix))
    return found.orderBy("SK")


def query_partitions(items: DataFrame, keys: DataFrame, prefix: str | None = None) -> DataFrame:
    """The same for every PK in ``keys``."""
    found = items if prefix is None else items.filter(F.col("SK").startswith(prefix))
    wanted = keys.select(F.col("PK").alias("__wanted")).filter(F.col("__wanted").isNotNull()).distinct()
    return keyed_join(found, wanted, "PK", "__wanted", "left_semi")


def index_items(items: DataFrame, index: IndexSpec) -> DataFrame:
    """Items that belong to the sparse index: those with a non-empty index key, all attributes kept."""
    return items.filter(F.col(index.partition).isNotNull() & (F.col(index.partition) != ""))


def index_layout(items: DataFrame, index: IndexSpec, partitions: int | None = None) -> DataFrame:
    """The index laid out by range for writing.

    The range runs over both key parts, so an index key shared by very many items (all artists,
    all tracks without an album) is cut into several partitions.
    """
    keys = [index.partition, index.sort]
    members = index_items(items, index)
    return members.repartitionByRange(partitions or shuffle_partitions(items), *keys).sortWithinPartitions(*keys)


def query_index(items: DataFrame, index: IndexSpec, value: str, prefix: str | None = None) -> DataFrame:
    """Items under one index key, in index sort order."""
    found = items.filter(F.col(index.partition) == value)
    if prefix is not None:
        found = found.filter(F.col(index.sort).startswith(prefix))
    return found.orderBy(index.sort)


def query_index_many(items: DataFrame, index: IndexSpec, keys: DataFrame, key: str) -> DataFrame:
    """Items under every index key in ``keys``."""
    wanted = keys.select(F.col(key).alias("__wanted")).filter(F.col("__wanted").isNotNull()).distinct()
    return keyed_join(index_items(items, index), wanted, index.partition, "__wanted", "left_semi")


def search_name(items: DataFrame, index: IndexSpec, name: str) -> DataFrame:
    """Exact name search through the search index; case does not matter."""
    return query_index(items, index, f"SEARCH#{name.upper()}")


def contains(items: DataFrame, column: str, text: str) -> DataFrame:
    """Substring search without regard to case."""
    return items.filter(F.upper(column).contains(text.upper()))


def where(items: DataFrame, **equal: object) -> DataFrame:
    """Items whose attributes equal the given values (genre, artist, entity type, ...)."""
    conditions: list[Column] = [F.col(name) == value for name, value in equal.items()]
    return items.filter(reduce(lambda a, b: a & b, conditions)) if conditions else items


def scan(items: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """All items, or a page of them in key order."""
    return page(items, ["PK", "SK"], limit, offset) if limit or offset else items


def count_by_entity(items: DataFrame) -> DataFrame:
    return items.groupBy("EntityType").agg(F.count(F.lit(1)).alias("item_count"))
