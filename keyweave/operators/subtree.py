"""Subtrees of a hierarchy as ranges of labels.

Walking around every tree (each node entered, its children visited, the node left) gives every node an
interval that holds exactly the nodes below it. A subtree is then a range that a scan prunes, and any total
over subtrees is the difference of two running totals.

In trees of few levels the sizes of subtrees go up and the labels down level by level, so each node takes
part in two small joins. In deeper ones the walk is a linked list of two arcs a node; its order comes from
pointer doubling, so a tree of any depth takes log2(arcs) joins, and no join has a hot key: each arc follows
exactly one other.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.functions.keys import is_linked
from keyweave.operators.hierarchy import chain_ends
from keyweave.operators.joins import keyed_join, one_row_per_key
from keyweave.operators.ordering import with_group_positions
from keyweave.session import scratch_path, stored

#: Labels of one block of running totals; the totals of all blocks pass through one window.
TOTALS_BLOCK = 1 << 20


#: Levels up to which labels are given level by level.
LEVELS = 48


def _nodes(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Distinct nodes with their link."""
    numeric = isinstance(df.schema[parent].dataType, T.NumericType)
    linked = is_linked(parent) if numeric else F.col(parent).isNotNull()
    nodes = df.select(F.col(key).alias("node"), F.when(linked, F.col(parent)).alias("up")).filter("node IS NOT NULL")
    return one_row_per_key(nodes, ["node"], [F.col("up").desc_nulls_last()])


def _tree(nodes: DataFrame) -> DataFrame:
    """Nodes with their parent (NULL without one that is a node), and their place among its children."""
    known = nodes.select(F.col("node").alias("known"), F.lit(True).alias("found"))
    met = keyed_join(nodes, known, "up", "known", rows_of=nodes)
    nodes = met.select("node", F.when(F.col("found"), F.col("up")).alias("up"))
    return with_group_positions(nodes, ["up"], ["node"], name="place")


def _arcs(tree: DataFrame) -> DataFrame:
    """The walk: arcs (``node``, ``leave``) and the arc after each; nothing follows the last one.

    A node is entered before its children and left after them. The trees stand one after the other.
    """
    tree = stored(tree, "tree")
    first = tree.filter("place = 0 AND up IS NOT NULL").select(F.col("up").alias("of"), F.col("node").alias("child"))
    after = tree.select(F.struct("up", "place").alias("at"), F.col("node").alias("sibling"))
    # Both are unique by their key: one first child a parent, one sibling a place.
    steps = tree.join(first, F.col("node") == F.col("of"), "left").join(
        after, F.struct("up", (F.col("place") + 1).alias("place")) == F.col("at"), "left"
    )

    def arc(leave: bool, node: Column, to: Column) -> Column:
        return F.struct(F.lit(leave).alias("leave"), node.alias("next"), to.alias("next_leave"))

    child, sibling, up = F.col("child"), F.col("sibling"), F.col("up")
    into = arc(False, F.coalesce(child, "node"), child.isNull())
    out = arc(True, F.coalesce(sibling, up), F.when(F.coalesce(sibling, up).isNotNull(), sibling.isNull()))
    return steps.select("node", F.explode(F.array(into, out)).alias("arc")).select("node", "arc.*")


def subtree_labels(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows (``key``, ``first``, ``last``, ``depth``): a node is below another if its ``first`` is in that one's
    range behind its own ``first``.

    Labels run from 0 without gaps; children of a node come by key. A node without a link, or whose parent is
    no node, is a root. Nodes on a cycle or below one have NULL labels. Repeated keys count once, NULL keys not.
    """
    nodes = stored(_nodes(df, key, parent), "nodes")
    ends = stored(chain_ends(nodes), "depths")
    deepest = ends.agg(F.max("depth")).first()[0] or 0
    if deepest < LEVELS:
        labels = _labels_by_level(nodes, ends, deepest)
        nothing = F.lit(None).cast("bigint")
        labels = labels.unionByName(
            ends.filter("depth IS NULL").select("node", nothing.alias("first"), nothing.alias("last"), "depth")
        )
    else:
        labels = _labels_by_walk(nodes)
    return stored(labels.withColumnRenamed("node", key), "labels")


def _labels_by_level(nodes: DataFrame, ends: DataFrame, deepest: int) -> DataFrame:
    """Sizes from the lowest level up, then labels from the roots down; a step reads one level and its neighbour."""
    spark = nodes.sparkSession
    path = scratch_path(spark, "levels")
    # Both sides have a node once; a node of depth 0 is a root, whatever its link says.
    placed = nodes.join(ends.filter("depth IS NOT NULL").select("node", "depth"), "node")
    placed.select("node", F.when(F.col("depth") > 0, F.col("up")).alias("up"), "depth").write.partitionBy("depth").parquet(path)
    levels = spark.read.schema(T.StructType([*nodes.schema, T.StructField("depth", T.LongType())])).parquet(path)
    sized = []
    for level in range(deepest, -1, -1):
        here = levels.filter(F.col("depth") == level)
        if sized:
            below = sized[-1].groupBy("up").agg(F.sum("size").alias("all")).select(F.col("up").alias("of"), "all")
            here = keyed_join(here, below, "node", "of", rows_of=nodes).withColumn("size", F.coalesce("all", F.lit(0)) + 1).drop("all")
        else:
            here = here.withColumn("size", F.lit(1).cast("bigint"))
        sized.append(stored(here, "sizes"))
    # A node comes behind its parent and all that is below its earlier siblings.
    path = scratch_path(spark, "siblings")
    siblings = with_group_positions(reduce(DataFrame.unionByName, sized), ["up"], ["node"], weight="size", name="before")
    siblings.write.partitionBy("depth").parquet(path)
    siblings = spark.read.schema(siblings.schema).parquet(path)
    found = []
    for level in range(deepest + 1):
        here = siblings.filter(F.col("depth") == level)
        if found:
            above = found[-1].select(F.col("node").alias("of"), F.col("first").alias("start"))
            here = keyed_join(here, above, "up", "of", rows_of=nodes).withColumn("first", F.col("start") + 1 + F.col("before"))
        else:
            here = here.withColumn("first", F.col("before"))
        last = F.col("first") + F.col("size") - 1
        found.append(stored(here.select("node", "first", last.alias("last"), "depth"), "firsts"))
    return reduce(DataFrame.unionByName, found)


def _labels_by_walk(nodes: DataFrame) -> DataFrame:
    entered = F.when(F.col("leave"), 0).otherwise(1).cast("bigint")
    step = F.when(F.col("leave"), -1).otherwise(1).cast("bigint")
    # ``ahead`` and ``rise``: nodes entered, and levels gone down, from this arc up to before its pointer.
    lists = stored(_arcs(_tree(nodes)).withColumns({"ahead": entered, "rise": step}), "arcs")
    done = lists.filter("next IS NULL").select("node", "leave", "ahead", "rise")
    active = lists.filter("next IS NOT NULL")
    rounds = math.ceil(math.log2(max(2, lists.count()))) + 1
    for _ in range(rounds):
        if active.isEmpty():
            break
        unended = {"to": F.lit(None).cast(active.schema["next"].dataType), "to_leave": F.lit(None).cast("boolean")}
        targets = done.select(F.col("node").alias("n"), F.col("leave").alias("l"), F.col("ahead").alias("a"), F.col("rise").alias("r")).withColumns(unended)
        targets = targets.unionByName(
            active.select(
                F.col("node").alias("n"), F.col("leave").alias("l"), F.col("ahead").alias("a"), F.col("rise").alias("r"),
                F.col("next").alias("to"), F.col("next_leave").alias("to_leave"),
            )
        )
        met = active.join(targets, (F.col("next") == F.col("n")) & (F.col("next_leave") == F.col("l")))
        stepped = stored(
            met.select(
                "node", "leave", F.col("to").alias("next"), F.col("to_leave").alias("next_leave"),
                (F.col("ahead") + F.col("a")).alias("ahead"), (F.col("rise") + F.col("r")).alias("rise"),
            ),
            "arcs",
        )
        done = done.unionByName(stepped.filter("next IS NULL").select("node", "leave", "ahead", "rise"))
        active = stepped.filter("next IS NOT NULL")
    total = done.filter("NOT leave").count()
    labels = done.groupBy("node").agg(
        F.max(F.when(~F.col("leave"), F.lit(total) - F.col("ahead"))).alias("first"),
        F.max(F.when(F.col("leave"), F.lit(total - 1) - F.col("ahead"))).alias("last"),
        F.max(F.when(~F.col("leave"), -F.col("rise"))).alias("depth"),
    )
    nothing = F.lit(None).cast("bigint")
    looping = active.filter("NOT leave").select("node", nothing.alias("first"), nothing.alias("last"), nothing.alias("depth"))
    return labels.unionByName(looping)


def write_labels(labels: DataFrame, path: str) -> None:
    """Store labels (with any other columns) sorted by ``first``, so that a subtree is a few row groups."""
    labels.repartitionByRange("first").sortWithinPartitions("first").write.parquet(path)


def subtree(labels: DataFrame, key: str, node: object, itself: bool = False) -> DataFrame:
    """All rows below a node: its range is looked up, and the scan gets it as two bounds."""
    found = labels.filter((F.col(key) == node) & F.col("first").isNotNull()).select("first", "last").head()
    if found is None:
        return labels.filter(F.lit(False))
    return labels.filter(F.col("first").between(found["first"] + (0 if itself else 1), found["last"]))


def subtree_totals(labels: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``labels`` with the sum of each value over all nodes below (not of the node itself), and their number ``below``.

    Running totals along the labels, first inside blocks and then over the blocks; a subtree's sum is the
    total at its last label less the total at its first.
    """
    labelled = labels.filter(F.col("first").isNotNull())
    rows = labelled.select(
        F.col("first").alias("at"), F.floor(F.col("first") / TOTALS_BLOCK).alias("block"), *[v.alias(n) for n, v in values.items()]
    )
    inside = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(*[F.sum(n).alias(f"all_{n}") for n in values])  # one row a block
    starts = blocks.select("block", *[F.coalesce(F.sum(f"all_{n}").over(before), F.lit(0)).alias(f"start_{n}") for n in values])
    running = stored(
        rows.select("at", "block", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"sum_{n}") for n in values])
        .join(starts, "block")
        .select("at", *[(F.col(f"start_{n}") + F.col(f"sum_{n}")).alias(f"sum_{n}") for n in values]),
        "totals",
    )
    first = running.select(F.col("at").alias("first"), *[F.col(f"sum_{n}").alias(f"first_{n}") for n in values])
    last = running.select(F.col("at").alias("last"), *[F.col(f"sum_{n}").alias(f"last_{n}") for n in values])
    # A label is one node's ``first``, so ``running`` is unique by it; many nodes may share a ``last``.
    met = keyed_join(labelled.join(first, "first"), last.withColumnRenamed("last", "__last"), "last", "__last", rows_of=labelled)
    return met.select(
        *labels.columns,
        (F.col("last") - F.col("first")).alias("below"),
        *[(F.col(f"last_{n}") - F.col(f"first_{n}")).alias(n) for n in values],
    )


def pairs_below(labels: DataFrame, key: str) -> DataFrame:
    """All pairs (``above``, ``below``) of a node and a node under it, as an equality join.

    A range of labels is a few aligned blocks of 1, 2, 4, ... labels, and a label lies in one block of each
    size; a node meets a range in exactly one block. So every pair comes once and no others are made.
    """
    labelled = labels.filter(F.col("first").isNotNull()).select(key, "first", "last")
    size = labelled.agg(F.max("last")).first()[0]
    levels = 1 if size is None else max(1, int(size + 1).bit_length())
    start = F.struct((F.col("first") + 1).alias("a"), (F.col("last") + 1).alias("b"), F.array().cast("array<struct<level:int,at:bigint>>").alias("blocks"))

    def narrowed(state: Column, level: Column) -> Column:
        a, b = state["a"], state["b"]
        open_ = a < b
        left, right = open_ & (a % 2 == 1), open_ & (b % 2 == 1) & (a + F.when(a % 2 == 1, 1).otherwise(0) < b)
        block = lambda at: F.array(F.struct(level.cast("int").alias("level"), at.cast("bigint").alias("at")))
        none = F.array().cast("array<struct<level:int,at:bigint>>")
        found = F.concat(state["blocks"], F.when(left, block(a)).otherwise(none), F.when(right, block(b - 1)).otherwise(none))
        return F.struct(F.floor((a + 1) / 2).alias("a"), F.floor(b / 2).alias("b"), found.alias("blocks"))

    cover = F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, narrowed)["blocks"]
    above = labelled.filter("last > first").select(F.col(key).alias("above"), F.explode(cover).alias("block"))
    places = F.transform(
        F.sequence(F.lit(0), F.lit(levels)),
        lambda level: F.struct(level.alias("level"), F.call_function("shiftright", F.col("first"), level).alias("at")),
    )
    below = labelled.select(F.col(key).alias("below"), F.explode(places).alias("block"))
    return above.join(below, "block").select("above", "below")
