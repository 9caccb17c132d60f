"""Benchmark decontamination by templates.

A text becomes a template: numbers, units after numbers and names (capitalised words inside a
sentence) turn into typed placeholders, everything else into lower-case words without marks. So a question
whose numbers and names were exchanged keeps its template. Windows of ``window`` template words are
hashed and joined with those of the benchmark; a window needs ``LITERALS`` words that are no placeholders. An item
with few such windows (a list of numbers, many names) is asked by windows of its words as they are; one shorter than
a window by all its words at once; one of fewer than ``LITERALS`` words is found where it is the whole text.

Matches on one diagonal (place in the document less place in the item) are one occurrence. It counts
if its slots are consistent: a value of the item stands for one value in the document throughout, and a
name there for one name here. An item is found in a document if consistent windows make up at least
``share`` of those it is asked by.

Column expressions only. The benchmark's windows and the list of documents that met one are broadcast while
they have at most BROADCAST_ROWS rows, which is checked; beyond that the joins shuffle.

Defined results: null and empty texts match nothing, nor do items that are; items
that are repeated are found each under its own item_id; rows with equal doc_id and text count as one document; a
null doc_id is reported as null; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import stored, table
from keyweave.llm.registry import query

WINDOW = 8
LITERALS = 4
SHARE = 0.5
BROADCAST_ROWS = 200_000
#: What a window is made of: template words, words as they are, or all words of a text.
TEMPLATE, RAW, WHOLE = "template", "raw", "whole"

# Fixed list of units that may follow a number.
UNITS = (
    "km|m|cm|mm|mi|miles?|feet|foot|ft|inch(?:es)?|kg|g|mg|lbs?|pounds?|ounces?|oz|tons?|l|ml|lit(?:er|re)s?|gallons?|"
    "s|sec(?:ond)?s?|min(?:ute)?s?|h|hours?|days?|weeks?|months?|years?|dollars?|cents?|euros?|percent|degrees?"
)
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
BLANK = r"\x20\x09-\x0D"
ALONE = rf"(?<![^{BLANK}])[^\p{{L}}\p{{N}}{BLANK}]++(?![^{BLANK}])"
NAMES = r"(?<=[\p{L}\p{N},;]\x20)\p{Lu}\p{Ll}++(?![\p{L}\p{N}])"
NUMBERS = r"(?<![\p{L}\p{N}])[0-9]++(?:[.,:/][0-9]++)*+"
UNITS_AFTER = rf"(?i)(?<=\x02\x20?)(?:{UNITS})(?![\p{{L}}\p{{N}}])"
MARKS = rf"[^\p{{L}}\p{{N}}\x01-\x03{BLANK}]++"


def words(text: Column) -> Column:
    """The text without words that are only marks, and without the placeholders' own characters."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, ""), ALONE, "")


def template(plain: Column) -> Column:
    """Placeholders for names, numbers and units; the number of words stays the same."""
    named = F.regexp_replace(plain, NAMES, NAME)
    numbered = F.regexp_replace(named, NUMBERS, NUMBER)
    return F.lower(F.regexp_replace(F.regexp_replace(numbered, UNITS_AFTER, UNIT), MARKS, ""))


def _split(text: Column) -> Column:
    return F.split(text, rf"[{BLANK}]+", -1)


def raw_words(plain: Column) -> Column:
    """Lower-case words without marks, numbers and names as they are; as many words as in the template."""
    return F.lower(F.regexp_replace(plain, MARKS, ""))


def _hashes(words: Column, kind: str, size: int) -> Column:
    """Hash of the window of ``size`` words at each place; none if there are fewer words."""
    found = F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1),
        lambda i: F.xxhash64(F.lit(kind), F.lit(size), *[F.get(words, i - 1 + j) for j in range(size)]),
    )
    return F.when(F.size(words) >= size, found)


def _whole(words: Column) -> Column:
    """The hash of all words, as a window at place 0; blanks at the ends of a text make no words."""
    return F.array(F.xxhash64(F.lit(WHOLE), F.filter(words, lambda w: w != F.xxhash64(F.lit("")))))


def windows(df: DataFrame, keys: list[str], asked: list[tuple[str, int]]) -> DataFrame:
    """keys, place and h: the windows of every kind and size that is asked; a row without place where there are none."""
    plain = df.select(*keys, words(F.col("text")).alias("plain"))
    hashed = lambda text: F.transform(_split(text), lambda w: F.xxhash64(w))
    needed = {kind for kind, _ in asked}
    arrays = plain.select(
        *keys,
        *([hashed(template(F.col("plain"))).alias("t")] if TEMPLATE in needed else []),
        *([hashed(raw_words(F.col("plain"))).alias("r")] if needed & {RAW, WHOLE} else []),
    )
    parts = [
        _whole(F.col("r")) if kind == WHOLE else _hashes(F.col("t" if kind == TEMPLATE else "r"), kind, size)
        for kind, size in asked
    ] or [F.lit(None).cast("array<bigint>")]
    # The outer form: for the inner one Spark would filter on the size first and compute the windows twice.
    if len(parts) == 1:
        return arrays.select(*keys, F.posexplode_outer(parts[0]).alias("place", "h"))
    nothing = F.array().cast("array<struct<place:int,h:bigint>>")
    placed = [F.coalesce(F.transform(p, lambda h, i: F.struct(i.alias("place"), h.alias("h"))), nothing) for p in parts]
    return arrays.select(*keys, F.explode_outer(F.concat(*placed)).alias("x")).select(*keys, "x.place", "x.h")


def _literals(text: Column) -> Column:
    return F.transform(_split(text), lambda w: F.when(w.rlike("[\x01-\x03]"), w).otherwise(F.lit("")))


def asked_windows(items: DataFrame, window: int, share: float) -> DataFrame:
    """Stored windows of the items: item_id, row, n (windows of the item), kind, w (words), at, h, item_words, kinds.

    An item is asked by windows of ``window`` words, or of all its words if it has fewer. They are windows of
    its template, those with LITERALS words at least, if these make up ``share`` of all; else windows of its
    raw words, without slots. An item shorter than a window is asked by both, as its one window's first word may
    pass for a name inside a text. An item of fewer than LITERALS words is asked as a whole document.
    ``row`` / 2 numbers the items.
    """
    plain = words(F.col("text"))
    benchmark = items.select("item_id", F.monotonically_increasing_id().alias("row"), plain.alias("plain")).filter(F.trim("plain") != "")
    # Words at the ends may be empty where a text begins or ends with a blank: they are no words.
    benchmark = benchmark.withColumn("plain", F.regexp_replace("plain", rf"^[{BLANK}]+|[{BLANK}]+$", ""))
    cut = stored(
        benchmark.select(
            "item_id",
            "row",
            _split(F.col("plain")).alias("raw"),
            _literals(template(F.col("plain"))).alias("kinds"),
            F.transform(_split(template(F.col("plain"))), lambda w: F.xxhash64(w)).alias("t"),
            F.transform(_split(raw_words(F.col("plain"))), lambda w: F.xxhash64(w)).alias("r"),
        ),
        "items",
    )
    long = F.size("raw")
    w = F.least(F.lit(window), long)
    literal = F.transform(
        F.sequence(F.lit(0), long - w), lambda at: F.size(F.filter(F.slice("kinds", at + 1, w), lambda k: k == "")) >= LITERALS
    )
    enough = F.size(F.filter("literal", lambda x: x))
    only = lambda *kinds: F.array(*map(F.lit, kinds))
    of_template = F.when(long < window, only(TEMPLATE, RAW)).otherwise(only(TEMPLATE))
    usable = (enough > 0) & (enough >= share * F.size("literal"))
    sized = cut.select("*", w.alias("w"), literal.alias("literal")).select(
        "*", F.explode(F.when(long < LITERALS, only(WHOLE)).when(usable, of_template).otherwise(only(RAW))).alias("kind")
    )

    def of(kind: str) -> Column:
        by_size = F.lit(None).cast("array<bigint>")
        for size in range(1, window + 1):
            by_size = F.when(F.col("w") == size, _hashes(F.col("t" if kind == TEMPLATE else "r"), kind, size)).otherwise(by_size)
        return by_size

    hashes = F.when(F.col("kind") == TEMPLATE, of(TEMPLATE)).when(F.col("kind") == RAW, of(RAW)).otherwise(_whole(F.col("r")))
    in_template = F.col("kind") == TEMPLATE
    found = sized.select(
        "item_id",
        (F.col("row") * 2 + (F.col("kind") == RAW).cast("int")).alias("row"),
        "kind",
        F.when(F.col("kind") == WHOLE, long).otherwise(F.col("w")).alias("w"),
        F.when(in_template, enough).otherwise(F.when(F.col("kind") == WHOLE, 1).otherwise(F.size("literal"))).alias("n"),
        "raw",
        F.when(in_template, F.col("kinds")).otherwise(F.transform("kinds", lambda _: F.lit(""))).alias("kinds"),
        "literal",
        F.posexplode(hashes).alias("at", "h"),
    ).filter(~in_template | F.get("literal", "at"))
    return stored(
        found.select(
            "item_id", "row", "kind", "n", "w", "at", "h",
            F.slice("raw", F.col("at") + 1, F.col("w")).alias("item_words"),
            F.slice("kinds", F.col("at") + 1, F.col("w")).alias("kinds"),
        ),
        "asked",
    )


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, matched (windows), coverage (share of the item's windows) and same_values, per document and item."""
    asked = asked_windows(items, window, share)
    # Kinds and sizes of windows: two a size at most, and whole documents.
    sizes = asked.select("kind", F.when(F.col("kind") != WHOLE, F.col("w")).otherwise(0)).distinct().collect()
    texts = docs.select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    there = windows(texts, ["doc_id", "key"], sorted(map(tuple, sizes)))
    met = stored(there.join(_small(asked.select("item_id", "row", "n", "w", "at", "h")), "h").drop("h"), "met")
    # The words of the documents that were met, to read the values in the slots.
    places = met.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.collect_list(F.struct("item_id", "row", "n", "w", "at", "place")).alias("places")
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("key").eqNullSafe(F.col("k"))
    cut = F.transform(
        "places", lambda x: F.struct(*[x[c].alias(c) for c in ("item_id", "row", "n", "at", "place")], F.slice("raw", x["place"] + 1, x["w"]).alias("doc_words"))
    )
    wanted = _small(met.select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct())
    # Stored, so that a text is split once and not for each of its windows.
    raw = stored(texts.join(wanted, same).select("doc_id", "key", _split(words(F.col("text"))).alias("raw")), "raw")
    hits = (
        raw.join(places, same)
        .select("doc_id", "key", F.explode(cut).alias("x"))
        .select("doc_id", "key", "x.*")
        .join(asked.select("row", "at", "item_words", "kinds"), ["row", "at"])
        .select(
            "doc_id",
            "key",
            "item_id",
            "row",
            "n",
            "at",
            (F.col("place") - F.col("at")).alias("diagonal"),
            F.zip_with(
                "doc_words",
                F.arrays_zip("item_words", "kinds"),
                lambda d, i: F.struct(i["kinds"].alias("kind"), _bare(i["item_words"]).alias("item"), _bare(d).alias("doc")),
            ).alias("slots"),
        )
    )
    # Equal windows of one occurrence merge first: a document with many occurrences stays in many rows.
    occurrence = ["doc_id", "key", "item_id", "row", "n", "diagonal"]
    slots = (
        hits.select(*occurrence, F.explode(F.filter("slots", lambda s: s["kind"] != "")).alias("s"))
        .select(*occurrence, "s.*")
        .distinct()
        .groupBy(*occurrence)
        .agg(
            F.count("*").alias("pairs"),
            F.count_distinct("kind", "item").alias("items"),
            F.sum(F.col("kind").contains(NAME).cast("int")).alias("name_pairs"),
            F.count_distinct(F.when(F.col("kind").contains(NAME), F.col("doc"))).alias("names"),
            F.min((F.col("item") == F.col("doc")).cast("int")).alias("same"),
        )
    )
    found = hits.groupBy(*occurrence).agg(F.count_distinct("at").alias("matched"))
    null_safe = [found[c].eqNullSafe(slots[c]) for c in occurrence]
    judged = found.join(slots, on=_all(null_safe), how="left").select(
        *[found[c] for c in occurrence], "matched", slots["pairs"], "items", "name_pairs", "names", "same"
    )
    consistent = judged.filter(F.col("pairs").isNull() | ((F.col("pairs") == F.col("items")) & (F.col("name_pairs") == F.col("names"))))
    found = (
        consistent.groupBy("doc_id", "key", "item_id", "row", "n")
        .agg(F.max("matched").alias("matched"), F.sum("matched").alias("all"), F.max_by(F.coalesce("same", F.lit(1)), "matched").alias("same"))
        .filter(F.col("all") >= share * F.col("n"))
    )
    # A short item may be found in both of its ways.
    best = found.groupBy("doc_id", "key", "item_id", F.floor(F.col("row") / 2)).agg(
        F.max(F.least("all", "n")).alias("matched"), F.max(F.least(F.lit(1.0), F.col("all") / F.col("n"))).alias("coverage"), F.max("same").alias("same")
    )
    return best.select("doc_id", "item_id", F.col("matched").cast("long").alias("matched"), "coverage", (F.col("same") == 1).alias("same_values"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of the size; a larger table is left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _bare(word: Column) -> Column:
    """A slot's value without marks around it."""
    return F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
