"""Exact inner-product search with a vector-approximation file.

Vectors are integer: floor(scale * x), x as double. Rows with equal vectors are one entry with their
smallest ids, as many as can appear in a result (ties go to the smaller id), so copies cost one entry.

The approximation file keeps ``bits`` per component: the number of the cell, of equal width between
the smallest and the largest component, that the value lies in. For a query, each cell gives a lower
and an upper bound of its part of the inner product.

1. The file and the queries are cut into groups of packed blocks; a task scans one group of the file for one
   group of queries (every row of the file is scanned for every query). Groups are few and large, as what
   moves and what stays grows with their number. The queries of a task are held, blocks of cells pass, and
   per query only entries stay whose upper bound reaches the k-th largest lower bound of the group. Cells are of
   equal width, so both bounds of a pair follow from one product of the query and the cell numbers.
2. The k-th largest lower bound of all groups prunes again. Exact vectors are read in the order of
   the upper bounds: the best k first, whose k-th exact score is then the bar; only entries whose
   bound reaches it are read after that. Nothing else can enter the result, so it is exact.

Defined results: vectors that are null, or hold a null or non-finite component, take no part; queries
only meet vectors of their length; a null id takes no part; components must stay below 2**26 after
scaling (else an error); repeated rows of one id and vector count once; fewer candidates than ``k`` give
fewer rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyweave.llm.corpus import shuffle_width, stored, table
from keyweave.llm.registry import query

#: Entries in a block of cells, queries in a block of queries.
CELL_ROWS = 4096
QUERY_ROWS = 1024
LARGEST = 2**26
#: A task of the scan has about so many pairs, the queries it holds so many rows and bytes at most.
TASK_PAIRS, HELD_QUERIES, HELD_BYTES = 2**28, 2**15, 2**25
#: Bounds of a block of queries that a task holds before it passes them on; about as many bytes of bounds does a query leave in each group.
HELD_BOUNDS, LEFT_BYTES = 2**18, 1500

BLOCK = pa.schema([("dim", pa.int32()), ("low", pa.int64()), ("width", pa.int64()), ("ids", pa.list_(pa.int64())), ("data", pa.binary())])
BLOCKS = "dim int, low long, width long, ids array<long>, data binary"
BOUNDS = "query long, entry long, low double, high double"


def integer_vectors(df: DataFrame, vector: str, scale: int) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(F.coalesce(~bad, F.lit(False)), F.transform(x, lambda c: F.floor(c * scale).cast("long")))


def bounds(cells: np.ndarray, low: np.ndarray, width: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, queries by entries."""
    start, spread = bound_parts(low, width, queries)
    least = queries @ (cells * width).T + start[:, None]
    return least, least + spread[:, None]


def bound_parts(low: np.ndarray, width: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a query adds to its product with ``cells * width`` for the lower bound, and for the upper one to that."""
    return queries @ low + np.minimum(queries, 0) @ (width - 1), np.abs(queries) @ (width - 1)


class Asked:
    """A block of queries, the ``need`` largest products of each with the cells of entries so far, and the entries that can matter."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, low: int, width: int, largest_cell: int, need: int):
        across = np.ones(queries.shape[1])
        self.ids, self.need, self.width = ids, need, float(width)
        self.start, self.spread = bound_parts(low * across, width * across, queries)
        exact = np.abs(queries).sum(axis=1).max(initial=0) * largest_cell < 2**24
        self.queries = queries.astype(np.float32 if exact else np.float64)
        self.top = np.full((len(ids), need), -np.inf)
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def bar(self) -> np.ndarray:
        """The least product whose upper bound reaches the smallest of the ``need`` largest lower bounds."""
        return (self.top.min(axis=1) - np.floor(self.spread / self.width)).astype(self.queries.dtype)

    def scan(self, entries: np.ndarray, cells: np.ndarray) -> None:
        n = len(entries)
        found = self.queries @ cells.astype(self.queries.dtype).T
        first = n > self.need and not np.isfinite(self.top).any()
        if first:
            self.top = np.partition(found, n - self.need, axis=1)[:, n - self.need :].astype(np.float64)
        at = np.flatnonzero(found >= self.bar()[:, None])
        q, product = at // n, found.ravel()[at]
        better = product > self.top.min(axis=1)[q]
        if better.any() and not first:
            every = np.arange(len(self.ids))
            rows = np.concatenate([np.repeat(every, self.need), q[better]])
            values = np.concatenate([self.top.ravel(), product[better]])
            order = np.lexsort((-values, rows))
            rows, values = rows[order], values[order]
            nth = np.arange(len(rows)) - np.searchsorted(rows, every)[rows]
            self.top = values[nth < self.need].reshape(len(every), self.need)
        self.kept.append((q.astype(np.int32), entries[at % n], product))
        self.held += len(at)

    def prune(self) -> None:
        """Leave what the present bar leaves."""
        q, entry, product = (np.concatenate(x) for x in zip(*self.kept))
        stays = product >= self.bar()[q]
        self.kept = [(q[stays], entry[stays], product[stays])]
        self.held = len(self.kept[0][0])

    def bounds(self) -> pa.RecordBatch:
        """What is held, as rows of BOUNDS; nothing is held afterwards."""
        self.prune()
        ((q, entry, product),) = self.kept
        low = product.astype(np.float64) * self.width + self.start[q]
        columns = [self.ids[q], entry, low, low + self.spread[q]]
        self.kept, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "entry", "low", "high"])


def groups(entries: int, queries: int, dim: float, parts: int) -> tuple[int, int]:
    """Into how many groups the file and the queries go: few bytes are moved and left, tasks are small and many enough."""
    tasks = min(parts, max(16, math.ceil(entries * queries / TASK_PAIRS)))
    even = math.sqrt(tasks * queries * (4 * dim + LEFT_BYTES) / max(1, entries * (dim + 8)))
    least = math.ceil(max(queries / HELD_QUERIES, queries * dim * 4 / HELD_BYTES))
    of_queries = max(1, least, min(tasks, round(even)))
    return max(1, math.ceil(tasks / of_queries)), of_queries


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, bits: int = 6, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other rows."""
    spark = df.sparkSession
    rows = stored(
        df.select(
            F.col(id_col).cast("long").alias("id"), integer_vectors(df, vector, scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
        ).filter("id IS NOT NULL AND v IS NOT NULL"),
        "vectors",
    )
    largest = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if largest is not None and largest >= LARGEST:
        raise OverflowError("scaled components must stay below 2**26")
    need = k + 1  # the query itself may be among them
    first = Window.partitionBy("v").orderBy("id")
    kept = rows.select("v", "id").distinct().withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= need)
    entries = stored(
        kept.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "v", F.size("v").alias("dim")),
        "entries",
    )
    asking = stored(
        rows.filter("asks").select("v").distinct().join(entries.select("v", "entry"), "v").selectExpr("entry AS query", "v", "size(v) AS dim"),
        "asking",
    )

    # One row per length of vectors: the range of the components sets the cells.
    ranges = entries.groupBy("dim").agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"))
    ranges = ranges.select("dim", F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("high", F.lit(0)).alias("high"))
    width = F.ceil((F.col("high") - F.col("low") + 1) / 2**bits).cast("long")
    # Broadcast: joined by a shuffle, all entries of one length would meet in one task.
    cells = entries.join(F.broadcast(ranges.withColumn("width", width)), "dim").select(
        "dim",
        "low",
        "width",
        "entry",
        F.transform("v", lambda c: F.floor((c - F.col("low")) / F.col("width")).cast("int")).alias("cells"),
    )
    size = entries.agg(F.count("*"), F.avg("dim")).first()
    file_groups, query_groups = groups(size[0], asking.count(), size[1] or 0, shuffle_width(spark))
    kind = "<u1" if bits <= 8 else "<u2"

    def packed(size: int, kind: str):
        """Rows (dim, low, width, id, numbers) into packed blocks of up to ``size``, one length of vectors each."""

        def pack(batches):
            for batch in batches:
                for dim in pa.compute.unique(batch.column(0)).to_pylist():
                    mine = batch.filter(pa.compute.equal(batch.column(0), dim))
                    for at in range(0, mine.num_rows, size):
                        part = mine.slice(at, size)
                        low, width, ids, numbers = (part.column(i) for i in range(1, 5))
                        data = np.asarray(numbers.flatten()).astype(kind).tobytes()
                        out = [[dim], [low[0].as_py()], [width[0].as_py()], [ids.to_pylist()], [data]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, BLOCK.types)], schema=BLOCK)

        return pack

    file = cells.select("dim", "low", "width", "entry", "cells").repartition(max(file_groups, min(shuffle_width(spark), size[0] // CELL_ROWS)))
    file = stored(file.mapInArrow(packed(CELL_ROWS, kind), BLOCKS).withColumn("part", F.spark_partition_id() % file_groups), "cells")
    zero = F.lit(0).cast("long")
    blocks = asking.select("dim", zero.alias("low"), zero.alias("width"), "query", "v").repartition(query_groups)
    blocks = stored(blocks.mapInArrow(packed(QUERY_ROWS, "<i4"), BLOCKS).withColumn("part", F.spark_partition_id()), "questions")
    # Every group of the file meets every group of queries: both are repeated, queries come first.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = blocks.select(F.lit(True).alias("asks"), *BLOCK.names, "part", every(file_groups).alias("other"))
    asked = asked.withColumn("task", F.col("other") * query_groups + F.col("part"))
    scanned = file.select(F.lit(False).alias("asks"), *BLOCK.names, "part", every(query_groups).alias("other"))
    scanned = scanned.withColumn("task", F.col("part") * query_groups + F.col("other"))
    met = asked.unionByName(scanned).drop("part", "other").repartitionById(file_groups * query_groups, F.col("task"))

    def scan(batches):
        at, waiting, held = None, [], []
        for batch in batches:
            tasks, dims, lows, widths, asks = (batch.column(c).to_pylist() for c in ("task", "dim", "low", "width", "asks"))
            for i in range(batch.num_rows):
                dim = dims[i]
                if (tasks[i], dim) != at:
                    yield from (x.bounds() for x in held if x.held)
                    at, waiting, held = (tasks[i], dim), [], []
                ids = batch.column("ids")[i].values.to_numpy()
                data = np.frombuffer(batch.column("data")[i].as_buffer(), "<i4" if asks[i] else kind).reshape(len(ids), dim)
                if asks[i]:
                    # Copies: the batch goes, the queries stay.
                    waiting.append((ids.copy(), data.astype(np.float64)))
                    continue
                held += [Asked(*x, lows[i], widths[i], 2**bits - 1, need) for x in waiting]
                waiting = []
                for x in held:
                    x.scan(ids, data)
                    if x.held > HELD_BOUNDS:
                        x.prune()
                    if x.held > HELD_BOUNDS // 2:
                        yield x.bounds()
        yield from (x.bounds() for x in held if x.held)

    near = stored(met.sortWithinPartitions("task", "dim", F.desc("asks")).mapInArrow(scan, BOUNDS), "bounds")
    bar = (
        near.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("low"))))
        .filter(F.col("nth") <= need)
        .groupBy("query")
        .agg(F.count("*").alias("n"), F.min("low").alias("bar"))
    )
    certain = near.join(bar, "query").filter((F.col("n") < need) | (F.col("high") >= F.col("bar"))).select("query", "entry", "high")
    order = Window.partitionBy("query").orderBy(F.desc("high"), "entry")
    certain = stored(certain.withColumn("nth", F.row_number().over(order)), "candidates")

    def exact(some: DataFrame) -> DataFrame:
        product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
        return (
            some.join(asking.select("query", F.col("v").alias("a")), "query")
            .join(entries.select("entry", "ids", F.col("v").alias("b")), "entry")
            .select("query", "entry", "ids", product.alias("score"))
        )

    best = stored(exact(certain.filter(F.col("nth") <= need)), "best")
    reached = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("bar"))
    rest = certain.filter(F.col("nth") > need).join(reached, "query").filter(F.col("high") >= F.col("bar"))
    found = best.unionByName(exact(rest.select("query", "entry")))

    # Entries to rows: the best k + 1 ids of each distinct query vector serve all rows that hold it.
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ids = (
        found.select("query", F.explode("ids").alias("id"), "score")
        .withColumn("nth", F.row_number().over(ranked))
        .filter(F.col("nth") <= need)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("found"))
    )
    askers = rows.filter("asks").select("id", "v").distinct().join(asking.select("v", "query"), "v").select(F.col("id").alias("query_id"), "query")
    own = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return askers.join(ids, "query").select("query_id", F.posexplode(own).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )


ORACLE = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@query("op3_exact_topk", ORACLE)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
