"""Substring search through lists of trigrams.

For every item the index holds the three-letter sequences of a text (and the shorter ones at its end).
A search looks up the lists of its own sequences, the rarest ones, and intersects them; only the items
in all of these lists are read and compared with the text asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.access import contains
from keyweave.operators.upsert import KEYS
from keyweave.session import fits_broadcast, shuffle_partitions
from keyweave.sources.snapshots import Snapshots

#: Lists that a search intersects at most. Fewer lists only mean more items to compare.
MOST_LISTS = 4
SIZE = 3


def grams(text: Column) -> Column:
    """Distinct sequences of up to three letters from every position on, without regard to case; none for NULL."""
    upper = F.upper(text)
    positions = F.sequence(F.lit(1), F.length(upper))
    found = F.array_distinct(F.transform(positions, lambda i: F.substring(upper, i, F.lit(SIZE))))
    return F.when(F.length(upper) > 0, found)


class SubstringIndex:
    """Lists of one text column, stored below ``path`` and sorted by sequence, so that a search reads few row groups."""

    def __init__(self, spark: SparkSession, path: str, column: str, keys: Sequence[str] = KEYS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.column = column
        self.keys = tuple(keys)

    def build(self, items: DataFrame) -> None:
        """Write the lists and their lengths. A sequence that nearly all items have is cut into several tasks by the keys."""
        lists = items.select(F.explode(grams(F.col(self.column))).alias("gram"), *self.keys)
        order = ["gram", *self.keys]
        lists.repartitionByRange(shuffle_partitions(items), *order).sortWithinPartitions(*order).write.parquet(f"{self.path}/lists")
        self._lists().groupBy("gram").agg(F.count(F.lit(1)).alias("items")).write.parquet(f"{self.path}/lengths")

    def _lists(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    def rarest(self, text: str) -> list[str]:
        """The sequences of a text with the shortest lists, at most MOST_LISTS; a sequence without a list comes alone."""
        upper = self.spark.range(1).select(F.upper(F.lit(text))).first()[0]
        wanted = sorted({upper[i : i + SIZE] for i in range(len(upper) - SIZE + 1)})
        lengths = self.spark.read.parquet(f"{self.path}/lengths").filter(F.col("gram").isin(wanted))
        known = dict(lengths.collect())  # as many rows as the text has sequences
        missing = [g for g in wanted if g not in known]
        return missing[:1] or sorted(wanted, key=lambda g: (known[g], g))[:MOST_LISTS]

    def candidates(self, text: str) -> DataFrame:
        """Keys of all items that can hold the text; each once."""
        upper = F.upper(F.lit(text))
        if len(text) < SIZE or self.spark.range(1).select(F.length(upper)).first()[0] < SIZE:
            # Too short for a list: wherever it stands, a sequence begins with it.
            return self._lists().filter(F.col("gram").startswith(upper)).select(*self.keys).distinct()
        chosen = self.rarest(text)
        found = self._lists().filter(F.col("gram").isin(chosen))
        if len(chosen) == 1:
            return found.select(*self.keys)
        counted = found.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__lists"))
        return counted.filter(F.col("__lists") == len(chosen)).drop("__lists")

    def search(self, items: DataFrame | Snapshots, text: str) -> DataFrame:
        """Items whose text holds ``text`` without regard to case, as ``access.contains`` finds them.

        Of a stored collection only the buckets of candidates are read.
        """
        if not text:
            whole = items.read() if isinstance(items, Snapshots) else items
            return contains(whole, self.column, text)
        found = self.candidates(text)
        if isinstance(items, Snapshots):
            buckets = items.manifest()["buckets"]
            at = F.pmod(F.xxhash64(*items.keys), F.lit(buckets)).cast("int")
            items = items.read(buckets=[r[0] for r in found.select(at).distinct().collect()])  # one row a bucket
        # Candidates are unique by key, so no key can be hot.
        found = F.broadcast(found) if fits_broadcast(found) else found
        return contains(items.join(found, list(self.keys), "left_semi"), self.column, text)
