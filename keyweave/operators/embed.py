"""One-to-many embedding: child rows become an ordered list inside their parent.

A list is one value in one row, so its length needs a bound. Parents whose children fit ``page_size``
get exactly one list. A parent with more gets the first page in its own row and every further page
in a continuation row, so nothing is dropped and no list grows without limit.

Children are shuffled once, by parent: sorted in their partition, numbered, and cut into pages there.
Parents that hold a large share of all children take another way, in which their children are
spread by range over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.operators.joins import frequent_keys
from keyweave.operators.ordering import with_group_positions
from keyweave.session import exceeds_partition

PAGE_SIZE = 10_000


def embed(
    parents: DataFrame,
    key: str,
    children: DataFrame,
    fk: str,
    fields: dict[str, Column],
    into: str,
    count: str,
    page: str = "__page",
    page_size: int = PAGE_SIZE,
    lists: bool = True,
) -> DataFrame:
    """Add the list ``into`` (sorted by its fields in turn), the child ``count`` and the ``page``.

    Without ``lists`` the rows are the same but for the list: the children are only counted, so nothing but their
    link is read.

    ``key`` is unique in ``parents``. Childless parents get an empty list and 0; children without a
    parent vanish. There is one row per parent and page, so one row per parent unless it has more
    than ``page_size`` children.
    """
    if not lists:
        sizes = children.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias(count))
        pages = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / page_size)))
        zero = F.lit(0).cast("bigint")
        return (
            parents.join(sizes.withColumn(page, pages), F.col(key) == F.col("__fk"), "left")
            .drop("__fk")
            .withColumns({count: F.coalesce(count, zero), page: F.coalesce(page, zero)})
        )
    lines = children.filter(F.col(fk).isNotNull()).select(
        F.col(fk).alias("__fk"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("__child")
    )
    huge = frequent_keys(children, F.col(fk)) if exceeds_partition(children) else []
    if not huge:
        return _attach(parents, key, _lists(lines, page_size), into, count, page, "left")

    in_lines, in_parents = F.col("__fk").isin(huge), F.coalesce(F.col(key).isin(huge), F.lit(False))
    usual = _attach(
        parents.filter(~in_parents), key, _lists(lines.filter(~in_lines), page_size), into, count, page, "left"
    )
    # A huge parent has children, so an inner join keeps it; there are only as many as frequent keys.
    spread = _huge_lists(lines.filter(in_lines), page_size)
    return usual.unionByName(
        _attach(F.broadcast(parents.filter(in_parents)), key, spread, into, count, page, "inner")
    )


def _lists(lines: DataFrame, page_size: int) -> DataFrame:
    """Pages of each group. All steps share the one shuffle by ``__fk``."""
    ordered = Window.partitionBy("__fk").orderBy("__child")
    numbered = lines.select(
        "__fk",
        "__child",
        F.floor((F.row_number().over(ordered) - 1) / page_size).alias("__page"),
        F.count(F.lit(1)).over(Window.partitionBy("__fk")).alias("__size"),
    )
    return numbered.groupBy("__fk", "__page").agg(
        F.array_sort(F.collect_list("__child")).alias("__list"), F.first("__size").alias("__size")
    )


def _huge_lists(lines: DataFrame, page_size: int) -> DataFrame:
    """The same for huge groups: equal children are counted first, then placed, then cut into pages."""
    counted = lines.groupBy("__fk", "__child").agg(F.count(F.lit(1)).alias("__copies"))
    placed = with_group_positions(counted, ["__fk"], ["__child"], weight="__copies", name="__start")
    start, end, size = F.col("__start"), F.col("__start") + F.col("__copies"), F.lit(page_size)
    in_page = placed.withColumn(
        "__page", F.explode(F.sequence(F.floor(start / size), F.floor((end - 1) / size)))
    )
    low = F.greatest(start, F.col("__page") * size)
    high = F.least(end, (F.col("__page") + 1) * size)
    run = F.struct(low.alias("at"), F.array_repeat("__child", (high - low).cast("int")).alias("copies"))
    pages = in_page.groupBy("__fk", "__page").agg(F.array_sort(F.collect_list(run)).alias("__runs")).select(
        "__fk", "__page", F.flatten(F.transform("__runs", lambda part: part["copies"])).alias("__list")
    )
    # One row per huge group.
    sizes = placed.groupBy("__fk").agg(F.sum("__copies").alias("__size"))
    return pages.join(F.broadcast(sizes), "__fk")


def _attach(
    parents: DataFrame, key: str, lists: DataFrame, into: str, count: str, page: str, how: str
) -> DataFrame:
    """Join the lists, already partitioned by parent. Their size is not known to the optimizer, so
    the merge join is asked for instead of a broadcast of lists."""
    shaped = lists.select(
        "__fk", F.col("__list").alias(into), F.col("__size").alias(count), F.col("__page").cast("bigint").alias(page)
    )
    empty = F.array().cast(shaped.schema[into].dataType)
    zero = F.lit(0).cast("bigint")
    side = shaped.hint("merge") if how == "left" else shaped
    return (
        parents.join(side, F.col(key) == F.col("__fk"), how)
        .drop("__fk")
        .withColumns({into: F.coalesce(into, empty), count: F.coalesce(count, zero), page: F.coalesce(page, zero)})
    )


def flatten_children(
    df: DataFrame, into: str, keep: Sequence[str], ordinal: str = "ordinal", page: str | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """One row per embedded child with its place (0-based) among all children of the parent.

    ``page`` names the page column that ``embed`` wrote and ``page_size`` its page size; without it, the
    place is that in the row's own list.
    """
    before = F.lit(0) if page is None else F.col(page) * page_size
    rows = df.select(*dict.fromkeys([*keep, *([page] if page else [])]), F.posexplode(into).alias(ordinal, "__child"))
    return rows.select(*keep, (before + F.col(ordinal)).alias(ordinal), "__child.*")
