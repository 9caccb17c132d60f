"""Depth in a hierarchy and layers of a dependency graph, at row scale."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.functions.keys import is_linked
from keyweave.operators.joins import keyed_join, one_row_per_key
from keyweave.session import scratch_path, shuffle_partitions, stored


def depths(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows (``key``, ``root``, ``depth``): the top of each node's chain and the steps to it.

    A node without a link, or whose parent is no node, is a root of depth 0. Each round doubles the
    known part of every chain, so a chain of n nodes takes log2(n) joins. Finished nodes leave the
    rounds. Nodes that lead into a cycle have no root: ``root`` and ``depth`` are NULL.
    """
    nodes = df.select(F.col(key).alias("node"), F.when(is_linked(parent), F.col(parent)).alias("up"))
    nodes = one_row_per_key(nodes, ["node"], [F.col("up").desc_nulls_last()])
    return chain_ends(nodes).withColumnRenamed("node", key)


def chain_ends(nodes: DataFrame) -> DataFrame:
    """``depths`` of distinct rows (``node``, ``up``); any value but NULL is a link."""
    known = nodes.select(F.col("node").alias("known"))
    existing = keyed_join(nodes, known.withColumn("found", F.lit(True)), "up", "known", rows_of=nodes)
    chains = stored(
        existing.select(
            "node",
            F.when(F.col("found"), F.col("up")).alias("up"),
            F.when(F.col("found"), 1).otherwise(0).cast("bigint").alias("steps"),
        ),
        "chains",
    )
    # Invariant: ``up`` is the ancestor ``steps`` above the node; a root points to nothing.
    ends = chains.filter(F.col("up").isNull()).select("node", F.col("node").alias("root"), F.lit(0).cast("bigint").alias("depth"))
    active = chains.filter(F.col("up").isNotNull())
    done = ends
    rounds = math.ceil(math.log2(max(2, chains.count()))) + 1
    for _ in range(rounds):
        if active.isEmpty():
            break
        finished = done.select(
            F.col("node").alias("at"), F.col("root").alias("next"), F.col("depth").alias("more"), F.lit(True).alias("ended")
        )
        longer = active.select(
            F.col("node").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.lit(False).alias("ended")
        )
        stepped = stored(
            keyed_join(active, finished.unionByName(longer), "up", "at", rows_of=nodes).select(
                "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), "ended"
            ),
            "chains",
        )
        done = done.unionByName(
            stepped.filter("ended").select("node", F.col("up").alias("root"), F.col("steps").alias("depth"))
        )
        active = stepped.filter(~F.col("ended")).drop("ended")
    looping = active.select(
        "node", F.lit(None).cast(active.schema["node"].dataType).alias("root"), F.lit(None).cast("bigint").alias("depth")
    )
    return done.unionByName(looping)


def layers(nodes: DataFrame, edges: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows (``node``, ``layer``): nodes referenced by others come in earlier layers.

    ``edges`` has (``node``, ``needs``). Edges to itself or to no node are ignored. A node without needs is in
    layer 0, any other one behind the last of its needs. Nodes on a cycle, or behind one, have no such place:
    they make up the last layer.

    Chains of nodes with a single need are resolved first by doubling, so a chain of n layers takes
    log2(n) joins. The nodes with more needs are then freed by a frontier: a round reads the links of the nodes
    that the last round freed (their buckets only), and moves only nodes that these links reach and that wait
    for more.
    """
    names = nodes.select("node").distinct()
    links = edges.filter(F.col("node") != F.col("needs")).select("node", "needs").distinct()
    links = keyed_join(links, names.withColumnRenamed("node", "n"), "needs", "n", "left_semi")
    links = stored(keyed_join(links, names.withColumnRenamed("node", "n"), "node", "n", "left_semi"), "links")
    counts = links.groupBy("node").agg(F.count(F.lit(1)).alias("open"), F.max("needs").alias("one"))
    # Both sides have a node once. Where a node has one need it hangs on it, all others are ends of chains.
    counted = stored(names.join(counts, "node", "left").withColumn("open", F.coalesce("open", F.lit(0))), "needs")
    hanging = counted.select("node", F.when(F.col("open") == 1, F.col("one")).alias("up"))
    chains = stored(chain_ends(hanging), "chains")
    freed = _free(links, counted, chains, buckets or shuffle_partitions(nodes))
    ends = freed.select(F.col("node").alias("end"), F.col("layer").alias("end_layer"))
    placed = keyed_join(chains, ends, "root", "end", rows_of=names).select(
        "node", (F.col("end_layer") + F.col("depth")).alias("layer")
    )
    placed = stored(placed, "layers")
    last = placed.agg(F.coalesce(F.max("layer") + 1, F.lit(0)).alias("last")).scalar()
    return placed.select("node", F.coalesce("layer", last).cast("bigint").alias("layer"))


def _free(links: DataFrame, counted: DataFrame, chains: DataFrame, buckets: int) -> DataFrame:
    """Layers of the ends of chains: nodes without needs, and nodes with several once all of these are placed."""
    spark = links.sparkSession
    several = counted.filter("open > 1").select("node")
    # A need stands for the end of its chain, so many steps further; of several to one end the longest counts.
    needs = keyed_join(links, several.withColumnRenamed("node", "n"), "node", "n", "left_semi")
    ends = chains.select(F.col("node").alias("m"), F.col("root").alias("end"), F.col("depth").alias("steps"))
    reduced = keyed_join(needs, ends, "needs", "m", rows_of=chains).groupBy("node", "end").agg(F.max(F.col("steps") + 1).alias("steps"))
    # A need without an end leads into a cycle: it is counted, and never freed.
    total = reduced.groupBy("node").agg(F.count(F.lit(1)).alias("all"))
    path = scratch_path(spark, "needed_by")
    at = F.pmod(F.xxhash64("end"), F.lit(buckets)).cast("int")
    counts = total.select(F.col("node").alias("n"), "all")
    with_all = keyed_join(reduced.filter("end IS NOT NULL"), counts, "node", "n", rows_of=counted).select(*reduced.columns, "all")
    # An end that very many nodes need fills its bucket: several tasks write it.
    spread = F.pmod(F.xxhash64("node"), F.lit(16))
    with_all.withColumn("bucket", at).repartition("bucket", spread).write.partitionBy("bucket").parquet(path)
    by_end = spark.read.schema(T.StructType([*reduced.schema, T.StructField("all", T.LongType()), T.StructField("bucket", T.IntegerType())])).parquet(path)
    frontier = stored(counted.filter("open = 0").select("node", F.lit(0).cast("bigint").alias("layer")), "frontier")
    done, waiting = [frontier], None
    while True:
        touched = [r[0] for r in frontier.select(F.pmod(F.xxhash64("node"), F.lit(buckets)).cast("int")).distinct().collect()]
        if not touched:
            break
        reached = keyed_join(
            by_end.filter(F.col("bucket").isin(touched)), frontier.select(F.col("node").alias("freed"), "layer"), "end", "freed", "inner"
        ).select("node", "all", F.lit(1).cast("bigint").alias("met"), (F.col("layer") + F.col("steps")).alias("layer"))
        moved = reached if waiting is None else reached.unionByName(waiting)
        state = stored(moved.groupBy("node").agg(F.max("all").alias("all"), F.sum("met").alias("met"), F.max("layer").alias("layer")), "reached")
        frontier, waiting = state.filter("met = all").select("node", "layer"), state.filter("met < all")
        done.append(frontier)
        if len(done) > 50:  # so that the plan stays small
            done = [stored(reduce(DataFrame.unionByName, done), "freed")]
    return reduce(DataFrame.unionByName, done)
