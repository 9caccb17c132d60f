"""Near copies by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct shingles (``shingle`` words after lower-casing A-Z;
the whole sequence if it is shorter). Its sketch is the ``k`` smallest of them.

1. Documents with equal sets form one node, so copies cost one row each from here on.
2. Inverted lists of retained values give candidates. Two sketches at the threshold share at least
   0.8 k values less the sampling error (DEVIATIONS standard deviations; sets up to k are held whole, so this is exact there), so a
   node need only be listed under its rarest values: so many that two nodes with that overlap must
   meet in one. Values of one node only count first among them.
3. A list of up to LIST nodes yields its pairs. In a longer one every node is paired with the list's
   pivot only (its smallest document).
4. The sketch of the union estimates the similarity; pairs as many deviations below the threshold fall out. Full
   sets confirm the rest: first each node's best partner, then only what is not connected yet.
5. Around a pivot exact distances d are known, and 1 - Jaccard is a metric. Nodes that are not linked to
   the pivot can be linked to a node only if their d differ by no more than the threshold's distance.
   Members are dealt into blocks by d; blocks of different components that can hold a link are
   compared on full sets, in bounded tasks, and return links that connect, not all pairs.
6. Components of the links, by alternating stars.

Sets are of 64-bit hashes. Defined results: null and empty texts have an empty set, are linked with
nothing and kept; a null id sorts before all and stays null; rows with equal ids are one node of the
graph, with all their texts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import WORD, lower_ascii, mix64, stored, table, worker_store
from keyweave.llm.registry import query
from keyweave.operators.upsert import key_bits, marked

#: Longest inverted list that yields its pairs; nodes in a block.
LIST = 32
BLOCK = 128
NULL_ID = -(2**63)
#: Standard deviations of sampling error that lists and the union's estimate allow for: 4e-8 for a pair at the threshold.
DEVIATIONS = 5.5
_BASE = 0x9E3779B97F4A7C15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of a text's shingles."""
    store = worker_store("near_copies")
    known = store.setdefault("words", {})
    if len(known) > 400_000:
        known.clear()
    words = re.findall(WORD, lower_ascii(text or ""))
    if not words:
        return np.zeros(0, np.uint64)
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(values)
    width = min(shingle, n)
    out = np.zeros(n - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = out * np.uint64(_BASE) + values[j : n - width + 1 + j]
        out = mix64(out + np.uint64(shingle - width))
    return np.unique(out >> np.uint64(1))


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared, len(a) + len(b) - shared


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge (a, b)."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.selectExpr("a AS node", "b AS component").unionByName(edges.selectExpr("b AS node", "b AS component").distinct())
        before = state
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").selectExpr("b AS a", "m AS b")
        large = stored(large.filter("a != b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("b AS a", "m AS b").unionByName(least.selectExpr("a", "m AS b"))
        edges = stored(small.filter("a != b").distinct(), "edges")


def near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: linked where 100 * intersection >= ``percent`` * union."""
    threshold = percent / 100
    docs = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "text")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, keys, sketches = [], [], []
                for text in part.column(1):
                    values = shingle_hashes(text.as_py(), shingle)
                    sizes.append(len(values))
                    keys.append(xxhash.xxh128_digest(values.tobytes()))
                    sketches.append(values[:k].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))],
                    ["doc", "n", "key", "sketch"],
                )

    sets = stored(docs.mapInArrow(sketched, "doc long, n long, key binary, sketch array<long>"), "sets")
    filled = sets.filter("n > 0")
    classes = filled.groupBy("key").agg(F.min("doc").alias("node"))
    nodes = stored(
        filled.groupBy("key").agg(F.min("doc").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).drop("key"),
        "nodes",
    )
    values = nodes.select("node", F.explode("sketch").alias("v"))
    lists = values.groupBy("v").agg(F.count("*").alias("df"), F.min("node").alias("pivot")).filter("df > 1")
    # The retained values that others share, rarest first; a node's own values come before them.
    shared = (
        values.join(lists, "v")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v", "pivot"))).alias("shared"))
    )
    cap = int(threshold * k - DEVIATIONS * math.sqrt(threshold * (1 - threshold) * k))
    least = F.greatest(F.lit(1), F.least(F.ceil(F.col("n") * percent / 100 - 1e-9), F.lit(cap)))
    held = F.size("sketch")
    prefix = F.greatest(F.lit(0), held - least + 1 - (held - F.size("shared")))
    listed = stored(
        shared.join(nodes, "node")
        .select("node", "n", F.explode(F.slice("shared", F.lit(1), prefix.cast("int"))).alias("x"))
        .select("node", "n", "x.*"),
        "listed",
    )
    short = listed.filter(F.col("df") <= LIST).select("v", "node", "n")
    other = short.selectExpr("v", "node AS b", "n AS m")
    close = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    pairs = short.withColumnRenamed("node", "a").join(other, "v").filter((F.col("a") < F.col("b")) & close).select("a", "b").distinct()
    around = stored(listed.filter(F.col("df") > LIST).select("pivot", "node").distinct(), "around")
    spokes = around.filter("pivot != node").selectExpr("pivot AS a", "node AS b")

    # Estimate from the sketch of the union, and each node's best partner.
    of = nodes.select("node", "sketch")
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, k)
    in_both = F.size(F.array_intersect(F.array_intersect(union, F.col("x")), F.col("y")))
    margin = threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / k)
    guessed = stored(
        pairs.join(of.selectExpr("node AS a", "sketch AS x"), "a")
        .join(of.selectExpr("node AS b", "sketch AS y"), "b")
        .select("a", "b", (in_both / F.size(union)).alias("guess"))
        .filter(F.col("guess") >= margin),
        "guessed",
    )
    best = (
        guessed.selectExpr("b AS node", "a AS partner", "guess")
        .unionByName(guessed.selectExpr("a AS node", "b AS partner", "guess"))
        .groupBy("node")
        .agg(F.max(F.struct("guess", (-F.col("partner")).alias("p"))).alias("x"))
        .select(F.least("node", -F.col("x.p")).alias("a"), F.greatest("node", -F.col("x.p")).alias("b"))
    )

    # Full sets of the nodes that take part in a comparison.
    taking_part = (
        guessed.select(F.explode(F.array("a", "b")).alias("node")).unionByName(around.select(F.explode(F.array("pivot", "node")).alias("node"))).distinct()
    )

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t.as_py(), shingle).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "hashes"])

    taking_part = stored(taking_part.withColumnRenamed("node", "doc"), "taking_part")
    hashes = stored(
        _possible(docs, taking_part).join(taking_part, "doc", "left_semi").select("doc", "text").mapInArrow(full, "node long, hashes binary"),
        "hashes",
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [
                jaccard(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(s, pa.int64()) for s in (zip(*sizes) if sizes else ((), ()))]],
                ["a", "b", "inter", "uni"],
            )

    def exact(some: DataFrame) -> DataFrame:
        return (
            some.join(hashes.selectExpr("node AS a", "hashes AS x"), "a")
            .join(hashes.selectExpr("node AS b", "hashes AS y"), "b")
            .select("a", "b", "x", "y")
            .mapInArrow(compared, "a long, b long, inter long, uni long")
        )

    linked = F.col("inter") * 100 >= F.col("uni") * percent
    first = stored(exact(best.unionByName(spokes).distinct()), "first")
    links = first.filter(linked).select("a", "b")
    label = stored(components(links), "label")
    open_pairs = _apart(guessed.select("a", "b"), label).join(first.select("a", "b"), ["a", "b"], "left_anti")
    links = links.unionByName(stored(exact(open_pairs).filter(linked).select("a", "b"), "second"))
    label = stored(components(links), "label")

    # Around pivots: what the pivot does not connect.
    member = (
        first.join(spokes, ["a", "b"])
        .selectExpr("a AS pivot", "b AS node", "1 - inter / uni AS d")
        .unionByName(spokes.selectExpr("a AS pivot", "a AS node", "cast(0 as double) AS d").distinct())
    )
    named = member.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = named.groupBy("pivot").agg(F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    groups = groups.filter("lo != hi")
    reach = 1 - threshold
    slots = F.ceil(F.col("members") / (BLOCK * 2)).cast("int")
    placed = (
        named.join(groups.withColumn("slots", slots), "pivot")
        .withColumn("level", F.floor(F.col("d") * 10).cast("int"))
        .withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
        .withColumn("block", F.col("level") * F.col("slots") + F.col("slot"))
    )
    levels = F.sequence(F.col("level") - math.ceil(reach * 10), F.col("level") + math.ceil(reach * 10))
    meets = (
        placed.withColumn("level2", F.explode(levels))
        .withColumn("slot2", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .filter("level2 BETWEEN 0 AND 10")
        .withColumn("block2", F.col("level2") * F.col("slots") + F.col("slot2"))
        .select("pivot", F.least("block", "block2").alias("one"), F.greatest("block", "block2").alias("two"), "block", "node", "component")
    )

    def blocks(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_block_links(rows, percent), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    third = stored(
        meets.join(hashes, "node").groupBy("pivot", "one", "two").applyInArrow(blocks, "a long, b long"), "third"
    )
    label = stored(components(links.unionByName(third)), "label")

    of_doc = sets.join(classes, "key", "left").join(label, "node", "left")
    component = F.coalesce("component", "node", "doc")
    null_if = lambda c: F.when(c != NULL_ID, c)
    return of_doc.select(
        null_if(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        null_if(component).alias("component_id"),
        (F.col("doc") == component).alias("kept"),
    )


def _possible(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``doc`` may be in ``wanted``, by a bitmap of fixed size: the texts of most others need not be moved."""
    return marked(docs, key_bits(wanted, ["doc"]), ["doc"]).filter("__maybe").drop("__maybe")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose nodes are not in one component yet."""
    a = label.selectExpr("node AS a", "component AS ca")
    b = label.selectExpr("node AS b", "component AS cb")
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _block_links(rows: pa.Table, percent: int) -> list[dict]:
    """Links between nodes of different components in two blocks of one pivot: enough to connect, no more."""
    node, component, block = (np.array(rows[c].to_pylist()) for c in ("node", "component", "block"))
    one = rows["one"][0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()]
    first, second = np.flatnonzero(block == one), np.flatnonzero(block != one)
    if rows["one"][0].as_py() == rows["two"][0].as_py():
        second = first
    if not len(first) or not len(second) or len(set(component.tolist())) < 2:
        return []
    parent = {c: c for c in component.tolist()}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    sizes = np.array([len(s) for s in sets])
    shared = _intersections([sets[i] for i in first], [sets[i] for i in second])
    out = []
    union = sizes[first][:, None] + sizes[second][None, :] - shared
    for x, y in zip(*np.nonzero(shared * 100 >= union * percent)):
        i, j = first[x], second[y]
        a, b = root(int(component[i])), root(int(component[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append({"a": int(min(node[i], node[j])), "b": int(max(node[i], node[j]))})
    return out


def _intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by products of 0/1 matrices in bounded strips."""
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)))
    for at in range(0, len(common), columns):
        strip = common[at : at + columns]
        x, y = (np.zeros((len(s), len(strip)), np.float32) for s in (left, right))
        for matrix, some in ((x, left), (y, right)):
            for i, values in enumerate(some):
                values = values[np.searchsorted(values, strip[0]) : np.searchsorted(values, strip[-1], "right")]
                place = np.minimum(np.searchsorted(strip, values), len(strip) - 1)
                matrix[i, place[strip[place] == values]] = 1
        out += x @ y.T
    return out.astype(np.int64)


@query("op4_near_copies")
def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), shingle=4, percent=80)
