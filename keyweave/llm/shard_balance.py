"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Documents with equal texts form a group that cannot be divided. Differencing starts with one partial
partition per item (its bytes in one part, nothing in the others); the two partial partitions with
the largest spread are combined, the largest part of one with the smallest of the other, until one is
left. Large items thus cancel first and small ones level out what remains.

Items are bounded in number at any size of the corpus: a group with at least 1 / ITEMS of all bytes is
an item of its own (there are ITEMS of them at most), every other group falls by the hash of its text
into one of ITEMS bundles. The bytes of groups and bundles are summed on Spark; only the items' sums,
at most 2 x ITEMS rows, are differenced on the driver, and they come back as a broadcast map. Texts are
never shuffled to be assigned.

Defined results: a null text counts as empty, so null and empty texts are one group; a document's size is
its UTF-8 bytes plus one; slots run from 0 in each shard by doc_id (nulls first), then size and text;
rows with equal ids are all kept; an empty table gives no rows; other columns pass through ``write_shards``
and are not read otherwise. A group larger than a fair share keeps its shard to itself as far as the rest allows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import stored, table
from keyweave.llm.registry import query
from keyweave.operators.ordering import with_group_positions

#: Bundles, and the share of all bytes (1 / ITEMS) from which a group is an item of its own.
ITEMS = 1 << 14


def difference(sizes: list[int], parts: int) -> list[int]:
    """The part (0 to parts - 1) of each item, by Karmarkar-Karp differencing.

    A node of the merge tree holds its sums in ascending order. A merge keeps which positions of its
    two children make each of its own positions; the labels are read from the root down.
    """
    if not sizes:
        return []
    nodes: list[tuple | None] = [None] * len(sizes)  # a leaf holds its item in the last position
    heap = [(-size, n, (0,) * (parts - 1) + (size,)) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        # Oppositely ordered: position p of one meets position parts - 1 - p of the other.
        joined = sorted((left[p] + right[parts - 1 - p], p) for p in range(parts))
        nodes.append((a, b, [p for _, p in joined]))
        low = joined[0][0]
        # What all parts have counts for nothing in later differences.
        heapq.heappush(heap, (low - joined[-1][0], len(nodes) - 1, tuple(s - low for s, _ in joined)))
    labels: list[list[int] | None] = [None] * len(nodes)
    labels[-1] = list(range(parts))  # of each position of a node
    for n in range(len(nodes) - 1, len(sizes) - 1, -1):
        a, b, order = nodes[n]
        of = labels[n]
        left, right = [0] * parts, [0] * parts
        for position, p in enumerate(order):
            left[p] = right[parts - 1 - p] = of[position]
        labels[a], labels[b], labels[n] = left, right, None
    return [labels[n][parts - 1] for n in range(len(sizes))]


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _bundle(group: Column) -> Column:
    return F.pmod(F.xxhash64(group), F.lit(ITEMS)).cast("int")


def measured(docs: DataFrame) -> DataFrame:
    """Stored: doc_id, size, text_crc32 and the digest that stands for the text's group."""
    text = _text()
    return stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "sizes",
    )


def item_shards(sizes: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Shards of the large groups (group, shard) and of the bundles (bundle, shard); both at most ITEMS rows."""
    spark = sizes.sparkSession
    groups = stored(sizes.groupBy("group").agg(F.sum("size").alias("bytes")), "group_sizes")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = groups.filter(F.col("bytes") * ITEMS >= total).orderBy("group").collect()
    rest = groups.filter(F.col("bytes") * ITEMS < total).groupBy(_bundle(F.col("group")).alias("bundle"))
    bundles = rest.agg(F.sum("bytes").alias("bytes")).orderBy("bundle").collect()
    found = difference([r.bytes for r in (*large, *bundles)], shards)
    return (
        spark.createDataFrame([(r.group, s) for r, s in zip(large, found)], "group binary, shard int"),
        spark.createDataFrame([(r.bundle, s) for r, s in zip(bundles, found[len(large) :])], "bundle int, shard int"),
    )


def _placed(rows: DataFrame, large: DataFrame, bundles: DataFrame, name: str = "shard") -> DataFrame:
    """Rows with a column ``group``, each with its group's shard; both maps are bounded by ITEMS rows."""
    own = large.select(F.col("group").alias("_large"), F.col("shard").alias("_large_shard"))
    common = bundles.select(F.col("bundle").alias("_bundle"), F.col("shard").alias("_bundle_shard"))
    return (
        rows.join(F.broadcast(own), F.col("group") == F.col("_large"), "left")
        .join(F.broadcast(common), _bundle(F.col("group")) == F.col("_bundle"), "left")
        .withColumn(name, F.coalesce("_large_shard", "_bundle_shard"))
        .drop("_large", "_large_shard", "_bundle", "_bundle_shard")
    )


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, group, shard, slot."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    sizes = measured(docs)
    placed = _placed(sizes, *item_shards(sizes, shards))
    return with_group_positions(placed, ["shard"], ["doc_id", "size", "group"], name="slot")


def write_shards(docs: DataFrame, path: str, shards: int) -> DataFrame:
    """All documents with all their columns as Parquet below ``path/_shard=n``; returns shard, documents, bytes.

    The maps are joined to the texts, which are written where they are read: no text is shuffled. The
    folder's column is the first free name from ``_shard`` on.
    """
    sizes = measured(docs)
    maps = item_shards(sizes, shards)
    name = "_shard"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    rows = docs.select(F.struct("*").alias("doc"), F.unhex(F.sha2(_text(), 256)).alias("group"))
    _placed(rows, *maps).select("doc.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(path)
    return _placed(sizes, *maps).groupBy("shard").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("bytes"))


@query("op11_shard_balance")
def op11_shard_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
