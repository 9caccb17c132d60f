"""Table sets from parquet folders, and stored item collections with the indexes that follow them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.access import index_items
from keyweave.operators.upsert import KEYS
from keyweave.session import scratch_path, stored
from keyweave.sources.files import Files
from keyweave.sources.snapshots import Snapshots
from keyweave.specs import IndexSpec


class TableSet(Mapping):
    """Tables by name, each opened on first use: what a query does not need is not even looked at."""

    def __init__(self, openers: dict[str, Callable[[], DataFrame]]):
        self._openers = openers
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def __contains__(self, name: object) -> bool:
        return name in self._openers


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> TableSet:
    """Parquet tables of a folder; columns and filters are pruned into the scans by the queries."""
    return TableSet({name: (lambda n=name: spark.read.parquet(f"{folder}/{n}.parquet")) for name in names})


class CollectionStore:
    """Collections below one folder, each as versions of a bucketed table (see ``snapshots``).

    A put writes only the buckets its keys fall into, keeps new attributes, and brings every index of the
    collection up to the new version before it returns. Readers keep the version they have opened; old
    versions go by ``vacuum``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = ""):
        self.spark = spark
        self.root = (root or scratch_path(spark, "collections")).rstrip("/")
        self.prefix = prefix

    def path(self, name: str) -> str:
        return f"{self.root}/{self.prefix}{name}"

    def items(self, name: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.path(name)}/items", KEYS)

    def exists(self, name: str) -> bool:
        return self.items(name).current() is not None

    def create(self, name: str, items: DataFrame, force: bool = False, buckets: int | None = None) -> bool:
        """Create the collection; an existing one is kept unless ``force``. True when written."""
        store = self.items(name)
        if store.current() is not None and not force:
            return False
        store.create(items, buckets)
        self._follow(name)
        return True

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.items(name).read(version)

    def get(self, name: str, pk: str, sk: str) -> DataFrame:
        """One item, read from its bucket only."""
        return self.items(name).get(pk, sk)

    def upsert(self, name: str, items: DataFrame, removed: DataFrame | None = None) -> int:
        """Put items and take out the keys in ``removed``; the indexes follow. Returns the new version."""
        version = self.items(name).put(items, removed)
        self._follow(name)
        return version

    def drop(self, name: str) -> None:
        """Remove the collection with all versions and indexes; one that does not exist is no error."""
        Files(self.spark, self.path(name)).remove()

    def vacuum(self, name: str, keep: int = 1) -> None:
        """Remove all versions but the last ``keep`` of the collection and of its indexes."""
        self.items(name).vacuum(keep)
        for index in self.indexes(name):
            self._index(name, index).vacuum(keep)

    def item_count(self, name: str) -> int:
        return self.read(name).count() if self.exists(name) else 0

    def statistics(self, names: Iterable[str]) -> DataFrame:
        """Per collection: whether it exists and how many items it has."""
        parts = []
        zero = F.lit(0).cast("bigint")
        for name in names:
            here = self.exists(name)
            one = self.spark.range(1).select(zero.alias("item_count")) if not here else self.read(name).agg(
                F.count(F.lit(1)).alias("item_count")
            )
            parts.append(one.select(F.lit(name).alias("collection"), F.lit(here).alias("found"), "item_count"))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def indexes(self, name: str) -> list[IndexSpec]:
        """Indexes that follow the collection."""
        below = Files(self.spark, f"{self.path(name)}/indexes")
        found = []
        for index in below.names():
            spec = Snapshots(self.spark, f"{below.folder}/{index}", KEYS).manifest()["note"]["index"]
            found.append(IndexSpec(**spec))
        return found

    def _index(self, name: str, index: IndexSpec) -> Snapshots:
        keys = (index.partition, *KEYS)
        return Snapshots(self.spark, f"{self.path(name)}/indexes/{index.name}", keys, (index.partition, index.sort, *KEYS))

    def add_index(self, name: str, index: IndexSpec) -> None:
        """Build a sparse index of the stored collection; from now on it follows every put."""
        store = self.items(name)
        version = store.current()
        self._index(name, index).create(
            index_items(store.read(version), index), store.manifest(version)["buckets"], _note(index, version)
        )

    def read_index(self, name: str, index: IndexSpec) -> DataFrame:
        """The index at the collection's current version; one left behind by a writer that stopped is brought up first."""
        self._follow(name, [index])
        return self._index(name, index).read()

    def _follow(self, name: str, indexes: list[IndexSpec] | None = None) -> None:
        """Apply the changes since each index's version to it.

        An item whose index key moved or went is taken out under its old index key and put under its new
        one. A put that is repeated after a stop finds the same changes and gives the same index.
        """
        store = self.items(name)
        version = store.current()
        changes: dict[int, DataFrame] = {}
        for index in self.indexes(name) if indexes is None else indexes:
            target = self._index(name, index)
            at = target.manifest()["note"]["version"]
            if at == version:
                continue
            if index.partition not in store.read(version).columns:
                target.create(target.read().limit(0), note=_note(index, version))
                continue
            # Found once, for all indexes of that version and for both sides of a put.
            if at not in changes:
                changes[at] = stored(store.changes(at, version), "changes")
            changed = changes[at]
            there = changed.filter(_in_index(F.col("old"), index)).select(f"old.{index.partition}", *KEYS)
            now = changed.filter(_in_index(F.col("new"), index)).select("new.*")
            target.put(now, removed=there, note=_note(index, version))


def _in_index(row: Column, index: IndexSpec) -> Column:
    return row[index.partition].isNotNull() & (row[index.partition] != "")


def _note(index: IndexSpec, version: int) -> dict:
    return {"index": {"name": index.name, "partition": index.partition, "sort": index.sort}, "version": version}
