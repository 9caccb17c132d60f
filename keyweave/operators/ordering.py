"""Exact row positions and pages over data of any size.

``orderBy().offset(n)`` moves everything behind the offset through one task. Here the rows are
range-partitioned on the order, numbered inside each slice, and shifted by the size of the slices
before it, so no task ever holds more than one slice.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.operators.joins import comparable_columns
from keyweave.session import materialize, shuffle_partitions

_SLICE, _ROW, _BEFORE, _COUNT = "__slice", "__row", "__before", "__count"

# Deepest page (offset + limit) that each task may keep as its own top rows.
TOP_ROWS_BOUND = 100_000


def _columns(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def with_positions(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """Add the zero-based position of each row in the global order.

    The ordered slices are checkpointed, so the slice a row was counted in is stored with the row
    and a lost executor cannot change it. ``order_by`` should be unique where ties matter.
    """
    order = _columns(order_by)
    slices = materialize(
        df.repartitionByRange(partitions or shuffle_partitions(df), *order)
        .sortWithinPartitions(*order)
        .withColumn(_ROW, F.monotonically_increasing_id())
        # The generated id holds the partition above bit 33 and the row inside it below.
        .withColumn(_SLICE, F.shiftright(_ROW, 33))
        .withColumn(_ROW, F.col(_ROW) - F.shiftleft(F.col(_SLICE), 33))
    )
    sizes = slices.groupBy(_SLICE).agg(F.count(F.lit(1)).alias(_COUNT))
    # One row per slice: this window and the broadcast are bounded by the number of partitions.
    before = sizes.select(
        _SLICE,
        F.coalesce(
            F.sum(_COUNT).over(Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias(_BEFORE),
    )
    return (
        slices.join(F.broadcast(before), _SLICE)
        .withColumn(name, F.col(_BEFORE) + F.col(_ROW))
        .drop(_SLICE, _ROW, _BEFORE)
    )


def with_group_positions(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[Column | str],
    weight: str | None = None,
    name: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Zero-based position inside each group, safe for a group that holds most of the rows.

    With ``weight`` each row stands for that many equal rows and gets the position of the first.
    """
    order = _columns(order_by)
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    slices = materialize(
        df.repartitionByRange(partitions or shuffle_partitions(df), *group_by, *order).withColumn(
            _SLICE, F.spark_partition_id()
        )
    )
    sizes = slices.groupBy(_SLICE, *group_by).agg(F.sum(amount).alias(_COUNT))
    earlier = Window.partitionBy(*group_by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a slice can have begun in an earlier one: at most one row per slice.
    before = sizes.withColumn(_BEFORE, F.sum(_COUNT).over(earlier)).filter(F.col(_BEFORE) > 0).drop(_COUNT)
    renamed = before.select(
        F.col(_SLICE).alias("__s"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_by)], _BEFORE
    )
    same = F.col(_SLICE) == F.col("__s")
    for i, g in enumerate(group_by):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inside = Window.partitionBy(_SLICE, *group_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        slices.withColumn(_ROW, F.sum(amount).over(inside) - amount)
        .join(F.broadcast(renamed), same, "left")
        .withColumn(name, F.col(_ROW) + F.coalesce(F.col(_BEFORE), F.lit(0)))
        .drop(_SLICE, _ROW, _BEFORE, "__s", *[f"__g{i}" for i in range(len(group_by))])
    )


@dataclass(frozen=True)
class _Key:
    """One plain column of an order."""

    name: str
    dtype: T.DataType
    descending: bool
    nulls_first: bool

    def column(self) -> Column:
        c = F.col(f"`{self.name}`")
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    # The conditions are NULL or false for rows they do not mean, and plain enough to reach the scan.

    def equal(self, value: object) -> Column:
        c = F.col(f"`{self.name}`")
        return c.isNull() if value is None else c == F.lit(value).cast(self.dtype)

    def beside(self, value: object, behind: bool) -> Column:
        """Rows that the order puts behind the value, or before it."""
        c = F.col(f"`{self.name}`")
        nulls_on_that_side = self.nulls_first != behind
        if value is None:
            return F.lit(False) if nulls_on_that_side else c.isNotNull()
        limit = F.lit(value).cast(self.dtype)
        beyond = c < limit if self.descending == behind else c > limit
        return beyond | c.isNull() if nulls_on_that_side else beyond


def _plain_keys(df: DataFrame, order_by: Sequence[Column | str]) -> list[_Key] | None:
    """The order as plain columns, or None if it has other expressions or types without literals."""
    orders = df.orderBy(*order_by)._jdf.queryExecution().analyzed().order()
    keys = []
    for n in range(orders.size()):
        one = orders.apply(n)
        child = one.child()
        if child.getClass().getSimpleName() != "AttributeReference" or child.name() not in df.columns:
            return None
        dtype = df.schema[child.name()].dataType
        if not isinstance(dtype, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType)):
            return None
        keys.append(_Key(child.name(), dtype, one.direction().sql() == "DESC", one.nullOrdering().sql() == "NULLS FIRST"))
    return keys


class PositionIndex:
    """Positions of an order, stored once for any number of pages.

    The columns of the order alone are range-partitioned and checkpointed; the sizes of the slices, one row
    per partition, tell in which slice a position lies, and one look into that slice gives the key there. A
    page is then a range of keys, which the scan of the data prunes by its statistics. No other column
    is stored or shuffled.
    """

    def __init__(self, df: DataFrame, order_by: Sequence[Column | str], partitions: int | None = None):
        keys = _plain_keys(df, order_by)
        if keys is None:
            raise ValueError("the index takes plain columns of simple types")
        self.keys = keys
        order = [k.column() for k in keys]
        self.slices = materialize(
            df.select(*[F.col(f"`{k.name}`") for k in keys])
            .repartitionByRange(partitions or shuffle_partitions(df), *order)
            .withColumn(_SLICE, F.spark_partition_id())
        )
        sizes = dict(self.slices.groupBy(_SLICE).count().collect())  # one row per partition
        self.order = sorted(sizes)
        self.starts = [0, *accumulate(sizes[s] for s in self.order)]

    @property
    def rows(self) -> int:
        return self.starts[-1]

    def at(self, position: int) -> tuple[tuple, int]:
        """Key of the row at a position, and how many rows of that key come before it."""
        n = bisect_right(self.starts, position) - 1
        # One slice is what one task holds, as in any sort.
        within = Window.partitionBy(_SLICE).orderBy(*[k.column() for k in self.keys])
        found = (
            self.slices.filter(F.col(_SLICE) == self.order[n])
            .withColumns({_ROW: F.row_number().over(within), _BEFORE: F.rank().over(within)})
            .filter(F.col(_ROW) == position - self.starts[n] + 1)
            .first()
        )
        return tuple(found[k.name] for k in self.keys), found[_ROW] - found[_BEFORE]

    def _equal(self, key: tuple) -> Column:
        return reduce(lambda a, b: a & b, [k.equal(v) for k, v in zip(self.keys, key)])

    def _beside(self, key: tuple, behind: bool) -> Column:
        result = F.lit(False)
        for k, v in zip(reversed(self.keys), reversed(key)):
            result = k.beside(v, behind) | (k.equal(v) & result)
        return result

    def page(self, df: DataFrame, offset: int, limit: int | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit``; rows of equal keys come in the order of their other columns."""
        end = self.rows if limit is None else min(offset + limit, self.rows)
        if offset >= end:
            return df.limit(0)
        first, skip = self.at(offset)
        last, take = self.at(end) if end < self.rows else (None, 0)
        if first == last:
            return self._among_equals(df, first, skip, take)
        chosen = self._beside(first, True) if skip else self._beside(first, True) | self._equal(first)
        if last is not None:
            chosen = chosen & self._beside(last, False)
        parts = [df.filter(chosen)]
        if skip:
            parts.append(self._among_equals(df, first, skip, None))
        if take:
            parts.append(self._among_equals(df, last, 0, take))
        return reduce(DataFrame.unionAll, parts)

    def _among_equals(self, df: DataFrame, key: tuple, start: int, end: int | None) -> DataFrame:
        names = {k.name for k in self.keys}
        others = [F.col(f"`{c}`") for c in comparable_columns(df) if c not in names]
        equals = df.filter(self._equal(key))
        placed = with_positions(equals, others or [F.lit(0)], "__position").filter(F.col("__position") >= start)
        return (placed if end is None else placed.filter(F.col("__position") < end)).drop("__position")


def page(
    df: DataFrame,
    order_by: Sequence[Column | str],
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the order. No limit (or 0) means all that follow.

    A shallow page uses Spark's top-k operator; a deeper one is a range of keys between two positions (see
    ``PositionIndex``; keep one for more pages of the same data). Ties are ordered by the other comparable
    columns in both, so the depth of a page does not change what is on it.
    """
    if not offset and not limit:
        return df.orderBy(*_columns(order_by))
    order = [*_columns(order_by), *_columns(comparable_columns(df))]
    if limit and offset + limit <= TOP_ROWS_BOUND:
        ordered = df.orderBy(*order)
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    if _plain_keys(df, order_by) is not None:
        return PositionIndex(df, order_by).page(df, offset, limit or None)
    placed = with_positions(df, order, "__position").filter(F.col("__position") >= offset)
    if limit:
        placed = placed.filter(F.col("__position") < offset + limit)
    return placed.drop("__position")


def resume_after(df: DataFrame, order_by: Sequence[Column | str], done: int) -> DataFrame:
    """Rows still to be processed when the first ``done`` of the order are finished."""
    return page(df, order_by, offset=done) if done else df


def batches(df: DataFrame, order_by: Sequence[str], size: int = 25, limit: int = 25, name: str = "batch") -> DataFrame:
    """Number consecutive batches of at most ``min(size, limit)`` rows; only the last may be short."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    step = min(size, limit)
    placed = with_positions(df, order_by, "__position")
    return placed.withColumn(name, F.floor(F.col("__position") / step).cast("bigint")).drop("__position")
