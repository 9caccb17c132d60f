"""Check whole collections against their specification and their sources.

Every item is checked, in one pass per collection, and counted by its combination of faults. Only these
combinations leave the map side, so the result is bounded by the rules and not by the number of bad items.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.catalog import table_counts
from keyweave.operators.ordering import page
from keyweave.specs import CollectionSpec

STAMPS = ("EntityType", "CreatedAt", "UpdatedAt")

Collections = dict[str, DataFrame]


def _absent(items: DataFrame, name: str) -> Column:
    """True where the attribute is absent: NULL, or a column the collection does not have at all."""
    return F.col(name).isNull() if name in items.columns else F.lit(True)


def _fault(check: str, when: Column, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(check).alias("check"), text.alias("message")))


def key_faults(items: DataFrame, spec: CollectionSpec) -> list[Column]:
    """A missing key, or a partition key that has none of the collection's prefixes."""
    no_pk, no_sk = _absent(items, spec.partition), _absent(items, spec.sort)
    known = reduce(lambda a, b: a | b, [F.col(spec.partition).startswith(p) for p in spec.key_prefixes])
    return [
        _fault("key_presence", no_pk, f"missing {spec.partition}"),
        _fault("key_presence", ~no_pk & no_sk, f"missing {spec.sort}"),
        _fault("key_format", ~no_pk & ~no_sk & ~known, f"{spec.partition} without a known prefix"),
    ]


def required_faults(items: DataFrame) -> list[Column]:
    """The first absent attribute of those that every item needs."""
    first = F.coalesce(*[F.when(_absent(items, c), F.lit(c)) for c in STAMPS])
    return [_fault("required", first.isNotNull(), F.concat(F.lit("missing "), first))]


def entity_faults(items: DataFrame, spec: CollectionSpec) -> list[Column]:
    """Absent attributes that the item's entity type needs."""
    faults = []
    for entity, names in spec.required.items():
        absent = [_absent(items, n) for n in names]
        missing = F.concat_ws(", ", *[F.when(a, F.lit(n)) for a, n in zip(absent, names)])
        # The message is only made for an item that lacks something.
        lacks = (F.col("EntityType") == entity) & reduce(lambda a, b: a | b, absent)
        faults.append(_fault("entity_required", lacks, F.concat(F.lit(f"{entity} without "), missing)))
    return faults


def faults(items: DataFrame, spec: CollectionSpec, columns: list[Column]) -> DataFrame:
    """Counted faults with one example key each.

    Items are counted by their combination of faults, in one aggregation that makes no list for an item; the
    few combinations are taken apart afterwards. Spark sorts the rows of which it takes the least text, so items
    without a fault, which give no row, are left out before.
    """
    names = [f"__fault{n}" for n in range(len(columns))]
    example = F.col(spec.partition) if spec.partition in items.columns else F.lit(None).cast("string")
    combined = (
        items.select(example.alias("__example"), *[c.alias(n) for c, n in zip(columns, names)])
        .filter(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names], F.lit(False)))
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("items"), F.min("__example").alias("example"))
    )
    return (
        combined.select("items", "example", F.explode(F.array_compact(F.array(*names))).alias("fault"))
        .groupBy(F.col("fault.check").alias("check"), F.col("fault.message").alias("message"))
        .agg(F.sum("items").alias("items"), F.min("example").alias("example"))
        .select(F.lit(spec.name).alias("collection"), "check", "message", "items", "example")
    )


def all_faults(items: DataFrame, spec: CollectionSpec) -> list[Column]:
    return key_faults(items, spec) + required_faults(items) + entity_faults(items, spec)


def item_faults(items: DataFrame, spec: CollectionSpec) -> DataFrame:
    return faults(items, spec, all_faults(items, spec))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _counted(spec: CollectionSpec, items: DataFrame, columns: list[Column]) -> DataFrame:
    """Item counts and fault counts in the same pass over the items.

    Every item also carries an entry that is no fault and serves to count it. Items that only
    continue a very long list are told apart from those that stand for a source row.
    """
    whole = F.col("EntityType").isin(list(spec.entities)) if "EntityType" in items.columns else F.lit(False)
    present = F.struct(F.when(whole, "entity").otherwise("other").alias("check"), F.lit("").alias("message"))
    return faults(items, spec, [present, *columns])


def source_counts(specs: dict[str, CollectionSpec], sources: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame | None:
    """Source rows and items due per collection; a table used by several collections is read once.

    Collections without any source table have no row; None if that is all of them.
    """
    uses = [(t, n, t in specs[n].counted) for n in names for t in specs[n].sources if t in sources]
    tables = sorted({t for t, _, _ in uses})
    if not tables:
        return None
    spark = sources[tables[0]].sparkSession
    mapping = spark.createDataFrame(uses, "table_name string, collection string, counted boolean")
    counts = table_counts({t: sources[t] for t in tables})
    return counts.join(F.broadcast(mapping), "table_name").groupBy("collection").agg(
        F.sum("record_count").alias("source_count"),
        F.coalesce(F.sum(F.when(F.col("counted"), F.col("record_count"))), F.lit(0).cast("bigint")).alias("expected_count"),
    )


def count_rule(specs: dict[str, CollectionSpec]) -> Column:
    """Empty sources need an empty target; else equal counts, or between one and the source count."""
    s, t = F.col("source_count"), F.col("target_count")
    exact = F.col("collection").isin([n for n, spec in specs.items() if spec.exact_count])
    return F.when(s == 0, t == 0).when(exact, t == s).otherwise((t > 0) & (t <= s))


def _checked(
    specs: dict[str, CollectionSpec], sources: Mapping[str, DataFrame], collections: Collections, full: bool
) -> DataFrame:
    """Per collection: the counts of both sides and the list of fault messages."""
    found = _union([_counted(specs[n], df, all_faults(df, specs[n]) if full else []) for n, df in collections.items()])
    count = F.col("check").isin("entity", "other")
    zero = F.lit(0).cast("bigint")
    message = F.concat(F.col("items").cast("string"), F.lit(" items: "), F.col("message"))
    targets = found.groupBy("collection").agg(
        F.coalesce(F.sum(F.when(count, F.col("items"))), zero).alias("target_count"),
        F.coalesce(F.sum(F.when(F.col("check") == "entity", F.col("items"))), zero).alias("entity_count"),
        F.collect_list(F.when(~count, message)).alias("faults"),
    )
    spark = next(iter(collections.values())).sparkSession
    asked = spark.createDataFrame([(n,) for n in collections], "collection string")
    counts = source_counts(specs, sources, collections)
    if counts is None:
        counts = spark.createDataFrame([], "collection string, source_count bigint, expected_count bigint")
    # From the collections asked for, so that none without a source or an item is missing.
    joined = asked.join(counts, "collection", "left").join(targets, "collection", "left").withColumn(
        "no_source", F.col("source_count").isNull()
    )
    return joined.withColumns(
        {
            "source_count": F.coalesce("source_count", zero),
            "expected_count": F.coalesce("expected_count", zero),
            "target_count": F.coalesce("target_count", zero),
            "entity_count": F.coalesce("entity_count", zero),
            "faults": F.coalesce("faults", F.array().cast("array<string>")),
        }
    )


def reconcile_counts(
    specs: dict[str, CollectionSpec], sources: Mapping[str, DataFrame], collections: Collections
) -> DataFrame:
    """Source and target counts per collection, the rule's outcome and the exact number of items due."""
    return _checked(specs, sources, collections, full=False).select(
        "collection",
        "source_count",
        "expected_count",
        "target_count",
        count_rule(specs).alias("valid"),
        (F.col("entity_count") == F.col("expected_count")).alias("complete"),
    )


def verdicts(
    spark: SparkSession,
    specs: dict[str, CollectionSpec],
    sources: Mapping[str, DataFrame],
    collections: dict[str, DataFrame | None],
) -> DataFrame:
    """Per collection: valid, source_count, target_count and the list of issues.

    Unknown collections and those that do not exist (None) are invalid with one issue.
    """
    rejected = [(n, f"Unknown collection: {n}") for n in collections if n not in specs] + [
        (n, f"Collection does not exist: {n}") for n, df in collections.items() if n in specs and df is None
    ]
    present = {n: df for n, df in collections.items() if n in specs and df is not None}
    parts = []
    if present:
        s, t = F.col("source_count"), F.col("target_count")
        mismatch = F.concat(
            F.lit("Counts differ: "), s.cast("string"), F.lit(" source rows, "), t.cast("string"), F.lit(" items")
        )
        needed = F.col("collection").isin([n for n in present if not specs[n].may_be_empty])
        general = F.array(
            F.when(~count_rule(specs) & ~F.col("no_source"), mismatch),
            F.when(F.col("no_source"), F.lit("No source table was given")),
            F.when((t == 0) & needed, F.lit("No items in the collection"))
        )
        issues = F.array_sort(F.concat(F.array_compact(general), F.col("faults")))
        parts.append(
            _checked(specs, sources, present, full=True)
            .withColumn("issues", issues)
            .select("collection", (F.size("issues") == 0).alias("valid"), "source_count", "target_count", "issues")
        )
    if rejected:
        zero = F.lit(0).cast("bigint")
        parts.append(
            spark.createDataFrame(rejected, "collection string, issue string").select(
                "collection", F.lit(False).alias("valid"), zero.alias("source_count"), zero.alias("target_count"),
                F.array("issue").alias("issues"),
            )
        )
    return _union(parts)


def summary(results: DataFrame) -> DataFrame:
    """All valid, total source, total target and efficiency in percent (NULL without sources)."""
    totals = results.agg(
        F.min("valid").alias("valid"),
        F.sum("source_count").alias("source_count"),
        F.sum("target_count").alias("target_count"),
    )
    return totals.withColumn("efficiency", efficiency("target_count", "source_count"))


def efficiency(target: str, source: str) -> Column:
    share = F.col(target).cast("double") / F.col(source).cast("double") * F.lit(100.0)
    return F.when(F.col(source) > 0, share)


def report(results: DataFrame) -> DataFrame:
    """A line per collection and one for the whole: status, counts, issues and efficiency.

    Both come from one grouping, so the checks behind ``results`` run once.
    """
    lines = results.rollup("collection").agg(
        F.grouping("collection").alias("whole"),
        F.min("valid").alias("valid"),
        F.sum("source_count").alias("source_count"),
        F.sum("target_count").alias("target_count"),
        F.first(F.array_join("issues", "; ")).alias("issues"),
    )
    whole = F.col("whole") == 1
    return lines.select(
        F.when(whole, "SUMMARY").otherwise(F.col("collection")).alias("section"),
        F.when(F.col("valid"), "PASSED").otherwise("FAILED").alias("status"),
        "source_count",
        "target_count",
        F.when(whole, "").otherwise(F.col("issues")).alias("issues"),
        efficiency("target_count", "source_count").alias("efficiency"),
    )


def sample(items: DataFrame, n: int) -> DataFrame:
    """The first ``n`` items in key order."""
    return page(items, ["PK", "SK"], limit=n)


def transform_summary(specs: dict[str, CollectionSpec], sources: Mapping[str, DataFrame]) -> DataFrame:
    """Source rows per table, items due per collection, both totals and the efficiency."""
    counts = table_counts(sources)
    target = reduce(
        lambda acc, s: acc.when(F.col("table_name").isin(list(s.counted)), F.lit(s.label)),
        specs.values(),
        F.when(F.lit(False), F.lit("")),
    )
    mapped = counts.withColumn("label", target)
    source_lines = mapped.select(F.lit("source").alias("side"), F.col("table_name").alias("name"), "record_count")
    target_lines = mapped.filter(F.col("label").isNotNull()).select(
        F.lit("target").alias("side"), F.col("label").alias("name"), "record_count"
    )
    lines = source_lines.unionByName(target_lines)
    grouped = lines.rollup("side", "name").agg(
        F.sum("record_count").alias("records"), F.grouping_id().alias("level"),
        F.sum(F.when(F.col("side") == "source", F.col("record_count"))).alias("sources"),
        F.sum(F.when(F.col("side") == "target", F.col("record_count"))).alias("targets"),
    )
    share = F.when(F.col("sources") > 0, F.col("targets").cast("double") / F.col("sources").cast("double") * F.lit(100.0))
    return grouped.select(
        F.coalesce("side", F.lit("efficiency")).alias("side"),
        F.when(F.col("level") == 0, F.col("name")).otherwise(F.lit("TOTAL")).alias("name"),
        F.when(F.col("level") == 3, F.lit(None)).otherwise(F.col("records")).alias("records"),
        F.when(F.col("level") == 3, share).alias("percent"),
    )
