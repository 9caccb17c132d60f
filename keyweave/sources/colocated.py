"""A link table and the table it refers to, stored so that their join moves no row.

Both are written in the same number of buckets of the link, sorted by it, so a join of the two reads bucket
by bucket. Links that hold a large share of the rows would make one bucket large; their rows are stored apart
and meet the few rows they refer to as a broadcast. Rows without a link are among them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.joins import HOT_SHARE, frequent_keys, one_row_per_key
from keyweave.session import exceeds_partition, scratch_path, shuffle_partitions
from keyweave.sources.files import Files


class CoLocated:
    """One stored pair."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, "colocated")).rstrip("/")

    def _write(self, df: DataFrame, part: str, column: str, buckets: int) -> DataFrame:
        name = f"colocated_{uuid.uuid4().hex}"
        # The exchange deals rows as the buckets do, so each bucket becomes one file.
        df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column).option(
            "path", f"{self.root}/{part}"
        ).format("parquet").saveAsTable(name)
        stored = self.spark.table(name)
        stored.isEmpty()  # resolves the files
        self.spark.sql(f"DROP TABLE {name}")  # the files stay: only the name goes
        return stored

    def write(self, links: DataFrame, link: str, targets: DataFrame, key: str, buckets: int | None = None) -> None:
        """Store both sides; of several targets with one key the highest stays, as in every lookup."""
        self.link, self.key = link, key
        buckets = buckets or shuffle_partitions(links)
        # A link that would fill a quarter of a bucket or more.
        hot = frequent_keys(links, F.xxhash64(link), max(HOT_SHARE, 0.25 / buckets)) if exceeds_partition(links) else []
        apart = F.col(link).isNull() | F.xxhash64(link).isin(hot)
        targets = one_row_per_key(targets.filter(F.col(key).isNotNull()), [key])
        self.links = self._write(links.filter(~apart), "links", link, buckets)
        self.targets = self._write(targets, "targets", key, buckets)
        links.filter(apart).write.parquet(f"{self.root}/links_apart")
        # As many rows as there are hot links, which ``frequent_keys`` bounds.
        targets.filter(F.xxhash64(key).isin(hot)).write.parquet(f"{self.root}/targets_apart")
        self.schemas = links.schema, targets.schema

    def joined(self, take: dict[str, str | Column], matched: str) -> DataFrame:
        """All link rows with the columns ``take`` of their target, NULL without one, and the flag ``matched``."""
        links_apart = self.spark.read.schema(self.schemas[0]).parquet(f"{self.root}/links_apart")
        targets_apart = self.spark.read.schema(self.schemas[1]).parquet(f"{self.root}/targets_apart")

        def met(left: DataFrame, right: DataFrame, few: bool) -> DataFrame:
            side = right.select(F.col(self.key).alias("__key"), *[F.col(c).alias(n) for n, c in take.items()], F.lit(True).alias(matched))
            side = F.broadcast(side) if few else side
            found = left.join(side, F.col(self.link) == F.col("__key"), "left").drop("__key")
            return found.withColumn(matched, F.coalesce(F.col(matched), F.lit(False)))

        return met(self.links, self.targets, False).unionByName(met(links_apart, targets_apart, True))

    def drop(self) -> None:
        """Remove the files."""
        Files(self.spark, self.root).remove()
