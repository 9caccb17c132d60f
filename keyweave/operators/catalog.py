"""Profile of a set of tables: columns, declared keys, counts, relationships, orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.hierarchy import layers
from keyweave.operators.joins import keyed_join
from keyweave.specs import TableSpec

Tables = dict[str, DataFrame]
Specs = dict[str, TableSpec]

_COLUMN_SCHEMA = (
    "table_name string, position bigint, column_name string, data_type string, nullable boolean, "
    "primary_key boolean, foreign_key string, default_value string"
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def column_metadata(spark: SparkSession, tables: Tables, specs: Specs) -> DataFrame:
    """One row per column; reads schemas only. Key columns are never nullable."""
    rows = []
    for name, df in tables.items():
        spec = specs.get(name, TableSpec(name))
        for i, f in enumerate(df.schema.fields):
            fk = spec.foreign_key(f.name)
            pk = f.name in spec.primary_key
            rows.append(
                (name, i, f.name, f.dataType.simpleString(), f.nullable and not pk, pk,
                 fk.target if fk else None, spec.defaults.get(f.name))
            )
    return spark.createDataFrame(rows, _COLUMN_SCHEMA)


def column_profile(df: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """Row, NULL and distinct counts of every column in one row each.

    By default distinct counts are HyperLogLog estimates from a single aggregation without any
    further shuffle. ``exact`` groups (column, value) pairs first; equal values combine before the
    shuffle, so a very frequent value costs nothing extra.
    """
    names = df.columns
    if exact:
        value = [
            F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("value")) for n in names
        ]
        pairs = df.select(F.explode(F.array(*value)).alias("cell")).select("cell.*")
        per_value = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        found = per_value.groupBy("column_name").agg(
            F.sum("n").alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("distinct_count"),
        )
        # An empty table has no cells, but its columns still belong to the profile.
        seed = df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
        filled = seed.join(found, "column_name", "left")
        zero = F.lit(0).cast("bigint")
        return filled.select(
            F.lit(table).alias("table_name"),
            "column_name",
            *[F.coalesce(c, zero).alias(c) for c in ("row_count", "null_count", "distinct_count")],
        )
    stats: list[Column] = [F.count(F.lit(1)).alias("row_count")]
    for n in names:
        stats += [F.count(n).alias(f"present__{n}"), F.approx_count_distinct(n).alias(f"distinct__{n}")]
    one = df.agg(*stats)
    cells = [
        F.struct(
            F.lit(n).alias("column_name"),
            (F.col("row_count") - F.col(f"present__{n}")).alias("null_count"),
            F.col(f"distinct__{n}").alias("distinct_count"),
        )
        for n in names
    ]
    return one.select("row_count", F.explode(F.array(*cells)).alias("cell")).select(
        F.lit(table).alias("table_name"), "cell.column_name", "row_count", "cell.null_count", "cell.distinct_count"
    )


def profile_columns(spark: SparkSession, tables: Tables, specs: Specs, exact: bool = False) -> DataFrame:
    """Column metadata with the measured counts."""
    measured = _union([column_profile(df, name, exact) for name, df in tables.items()])
    return column_metadata(spark, tables, specs).join(measured, ["table_name", "column_name"])


def table_counts(tables: Tables) -> DataFrame:
    return _union(
        [df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(n).alias("table_name"), "record_count")
         for n, df in tables.items()]
    )


def catalog_counts(tables: Tables, total: str = "TOTAL") -> DataFrame:
    """Rows per table and a grand-total row."""
    counts = table_counts(tables)
    totals = counts.rollup("table_name").agg(F.sum("record_count").alias("record_count"), F.grouping("table_name").alias("whole"))
    return totals.select(F.when(F.col("whole") == 1, total).otherwise(F.col("table_name")).alias("table_name"), "record_count")


def source_statistics(tables: Tables, specs: Specs) -> DataFrame:
    """Per table: rows, columns, and whether it has foreign keys."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(n).alias("table_name"),
                "record_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                F.lit(bool(specs[n].foreign_keys)).alias("has_foreign_keys"),
            )
            for n, df in tables.items()
        ]
    )


def link_counts(tables: Tables, specs: Specs) -> DataFrame:
    """Per declared foreign key: rows with a link, distinct parents linked, rows without a parent.

    Children are counted per link value before they meet the parents, so a parent that holds most
    children is one row in the join.
    """
    parts = []
    for name, df in tables.items():
        for fk in specs[name].foreign_keys:
            if fk.table not in tables:
                continue
            values = (
                df.filter(F.col(fk.column).isNotNull())
                .groupBy(F.col(fk.column).alias("__value"))
                .agg(F.count(F.lit(1)).alias("__rows"))
            )
            parent = tables[fk.table].select(F.col(fk.ref_column).alias("__ref")).filter(F.col("__ref").isNotNull())
            known = parent.distinct().withColumn("__found", F.lit(True))
            zero = F.lit(0).cast("bigint")
            parts.append(
                values.join(known, F.col("__value") == F.col("__ref"), "left").agg(
                    F.coalesce(F.sum("__rows"), zero).alias("link_rows"),
                    F.count("__found").alias("linked_parents"),
                    F.coalesce(F.sum(F.when(F.col("__found").isNull(), F.col("__rows"))), zero).alias("orphan_rows"),
                ).select(
                    F.lit(name).alias("table_name"),
                    F.lit(fk.column).alias("fk_column"),
                    F.lit(fk.table).alias("ref_table"),
                    F.lit(fk.ref_column).alias("ref_column"),
                    "link_rows",
                    "linked_parents",
                    "orphan_rows",
                )
            )
    return _union(parts)


def orphans(tables: Tables, specs: Specs) -> DataFrame:
    """Foreign keys with rows whose parent does not exist, and a message for each.

    Rows are counted per link value first. The wording of the message is a fixed value.
    """
    parts = []
    for name, df in tables.items():
        for fk in specs[name].foreign_keys:
            if fk.table not in tables:
                continue
            values = (
                df.filter(F.col(fk.column).isNotNull())
                .groupBy(F.col(fk.column).alias("__value"))
                .agg(F.count(F.lit(1)).alias("__rows"))
            )
            parent = tables[fk.table].select(F.col(fk.ref_column).alias("__ref"))
            missing = values.join(parent, F.col("__value") == F.col("__ref"), "left_anti")
            count = missing.agg(F.coalesce(F.sum("__rows"), F.lit(0).cast("bigint")).alias("orphan_count"))
            parts.append(
                count.select(
                    F.lit(name).alias("table_name"),
                    F.lit(fk.column).alias("fk_column"),
                    F.lit(fk.target).alias("reference"),
                    "orphan_count",
                    F.concat(
                        F.lit("Found "),
                        F.col("orphan_count").cast("string"),
                        F.lit(f" orphaned records in {fk.column} referencing {fk.target}"),
                    ).alias("message"),
                )
            )
    return _union(parts).filter(F.col("orphan_count") > 0)


def relationships(tables: Tables, specs: Specs) -> DataFrame:
    """Per table: the tables it references and those referencing it, with the rows behind the links.

    Each measured foreign key counts for both of its tables, so the links are measured once. The
    lists hold one name per declared foreign key, so they are as short as the catalogue.
    """
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("string")

    def entry(table, refs, refd, outgoing, incoming, records):
        return F.struct(
            F.col(table).alias("table_name"), refs.alias("refs"), refd.alias("refd"), outgoing.alias("outgoing"),
            incoming.alias("incoming"), records.alias("records"),
        )

    links = link_counts(tables, specs).select(
        F.explode(
            F.array(
                entry("table_name", F.col("ref_table"), nothing, F.col("link_rows"), zero, zero),
                entry("ref_table", nothing, F.col("table_name"), zero, F.col("link_rows"), zero),
            )
        ).alias("e")
    )
    counts = table_counts(tables).select(
        entry("table_name", nothing, nothing, zero, zero, F.col("record_count")).alias("e")
    )
    return counts.unionByName(links).select("e.*").groupBy("table_name").agg(
        F.sum("records").alias("record_count"),
        F.array_sort(F.collect_list("refs")).alias("references"),
        F.array_sort(F.collect_list("refd")).alias("referenced_by"),
        F.sum("outgoing").alias("outgoing_rows"),
        F.sum("incoming").alias("incoming_rows"),
    )


def _links_to(spec: TableSpec, table: str, key: tuple[str, ...]) -> list[list[str]]:
    """Links of a table to another, each as its columns in the order of that one's key.

    A link to a composite key is one declared foreign key per key column; of several such links the first
    declarations of all columns belong together, then the second ones.
    """
    of = [[fk.column for fk in spec.foreign_keys if fk.table == table and fk.ref_column == c] for c in key]
    return [list(link) for link in zip(*of)]


def related_data(tables: Tables, specs: Specs, table: str, keys: DataFrame) -> Tables:
    """Child rows of the given parent keys for every table with a foreign key to ``table``.

    ``keys`` has all primary-key columns; a child matches by all of them. A table without a primary key has no
    related rows; links of a table to itself are skipped.
    """
    if table not in tables:
        raise ValueError(f"Table {table} is not in the catalogue")
    key = specs[table].primary_key
    if not key:
        return {}
    wanted = keys.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
    wanted = wanted.select((F.struct(*key) if len(key) > 1 else F.col(key[0])).alias("__wanted")).distinct()
    found: Tables = {}
    for name, df in tables.items():
        links = [] if name == table else _links_to(specs[name], table, key)
        if links:
            # A row counts once, by the first of its links that leads to one of the keys.
            rest, parts = df, []
            for i, link in enumerate(links):
                if i:
                    rest = keyed_join(rest, wanted, _link_key(links[i - 1], key), "__wanted", "left_anti")
                parts.append(keyed_join(rest, wanted, _link_key(link, key), "__wanted", "left_semi"))
            found[name] = reduce(DataFrame.unionByName, parts)
    return found


def _link_key(link: list[str], key: tuple[str, ...]) -> Column:
    """The linked key of a row; NULL if a part of it is."""
    if len(link) == 1:
        return F.col(link[0])
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in link])
    return F.when(whole, F.struct(*[F.col(c).alias(k) for c, k in zip(link, key)]))


def related_data_present(tables: Tables, specs: Specs, table: str, keys: DataFrame) -> Tables:
    """``related_data`` without the tables that have no related row; one job looks at all of them."""
    found = related_data(tables, specs, table, keys)
    if not found:
        return {}
    first = [df.limit(1).select(F.lit(n).alias("table_name")) for n, df in found.items()]
    present = {r["table_name"] for r in _union(first).collect()}  # one row per table
    return {n: df for n, df in found.items() if n in present}


def schema_analysis(spark: SparkSession, tables: Tables, specs: Specs) -> DataFrame:
    """One nested row per table with counts, columns, keys and relationships; write it as JSON."""
    columns = (
        column_metadata(spark, tables, specs)
        .groupBy("table_name")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("position", "column_name", "data_type", "nullable", "primary_key", "foreign_key", "default_value")
                )
            ).alias("columns")
        )
    )
    keys = spark.createDataFrame(
        [
            (n, list(specs[n].primary_key), {fk.column: fk.target for fk in specs[n].foreign_keys}, list(specs[n].indexes))
            for n in tables
        ],
        "table_name string, primary_keys array<string>, foreign_keys map<string,string>, indexes array<string>",
    )
    return relationships(tables, specs).join(columns, "table_name").join(keys, "table_name")


def load_order(spark: SparkSession, tables: Tables, specs: Specs) -> DataFrame:
    """Tables in dependency layers: referenced tables first, smaller ones first within a layer."""
    counts = table_counts(tables)
    edges = spark.createDataFrame(
        [(n, fk.table) for n in tables for fk in specs[n].foreign_keys], "node string, needs string"
    )
    placed = layers(counts.select(F.col("table_name").alias("node")), edges)
    return placed.join(counts, F.col("node") == F.col("table_name")).select(
        "table_name", "layer", "record_count"
    ).orderBy("layer", "record_count", "table_name")
