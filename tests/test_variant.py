"""Sparse items as VARIANT, and exact reads of encoded items."""

import pytest
from pyspark.sql import functions as F

from keyweave.functions.codec import decode_items, encode_items
from keyweave.functions.variant import attribute, attribute_names, decode_wire, merged, path, to_variant, wire, wire_attribute

SCHEMA = (
    "PK string, id bigint, ok boolean, price decimal(20,4), day date, tags array<string>, ids array<bigint>, "
    "m map<string,bigint>, s struct<a:bigint,b:array<struct<c:boolean>>>"
)
EXACT = 2**53 + 1


@pytest.fixture
def item(spark):
    from datetime import date
    from decimal import Decimal

    full = ("a", EXACT, True, Decimal("1234567890123456.7891"), date(2024, 2, 29), ["x", None], [EXACT, None, -EXACT], {"k": EXACT}, (EXACT, [(True,), (None,)]))
    return spark.createDataFrame([full, ("b", *[None] * 8)], SCHEMA)


def test_encoded_items_keep_every_digit(item):
    expected = {r.PK: r for r in item.collect()}
    encoded = encode_items(item)
    for decoded in (decode_items(encoded, item.schema), decode_wire(encoded, item.schema)):
        assert decoded.schema.simpleString() == item.schema.simpleString()
        assert {r.PK: r for r in decoded.collect()} == expected
    assert decode_items(encoded, item.schema, number="double").select("id").schema["id"].dataType.simpleString() == "double"


def test_single_paths_need_no_whole_schema(item):
    read = encode_items(item).select(wire("item").alias("v")).select(
        wire_attribute(F.col("v"), ["PK"], item.schema["PK"].dataType).alias("PK"),
        wire_attribute(F.col("v"), ["s", "a"], item.schema["id"].dataType).alias("a"),
    )
    assert {tuple(r) for r in read.collect()} == {("a", EXACT), ("b", None)}


def test_stored_variants(spark, item, tmp_path):
    to_variant(item.drop("day"), keep=("PK",)).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    found = stored.select(
        "PK", attribute("item", "id", "bigint"), attribute("item", ("m", "k"), "bigint"), attribute("item", ("s", "a"), "bigint"),
        attribute_names("item"),
    )
    assert {r[0]: tuple(r)[1:4] for r in found.collect()} == {"a": (EXACT,) * 3, "b": (None,) * 3}
    assert {r[0]: r[4] for r in found.collect()} == {"a": ["id", "ids", "m", "ok", "price", "s", "tags"], "b": []}
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        stored.select(attribute("item", "tags", "bigint")).collect()


def test_put_and_removed_attributes(spark):
    df = spark.createDataFrame([('{"a":1,"b":[1,2]}', '{"b":"new","c":true}', ["a", "z"]), ("{}", "{}", None)], "old string, new string, gone array<string>")
    found = df.select(merged(F.parse_json("old"), F.parse_json("new"), "gone").cast("string").alias("v"))
    assert [r.v for r in found.collect()] == ['{"b":"new","c":true}', "{}"]


def test_names_in_paths(spark):
    df = spark.createDataFrame([('{"a.b":1,"it\'s":2,"$x":3}',)], "t string").select(F.parse_json("t").alias("v"))
    assert tuple(df.select(*[attribute("v", n, "int") for n in ("a.b", "it's", "$x")]).first()) == (1, 2, 3)
    with pytest.raises(ValueError):
        path("both ' and \"")


def test_lists_are_read_by_one_cast(spark):
    schema = "PK string, lines array<struct<`it's a.b`:bigint,B:struct<`x``y`:array<boolean>,b:string>,m:map<string,bigint>>>"
    rows = [("a", [(EXACT, ([True, None], "t"), {"k.v": None, "w": 2}), (None, None, None), None]), ("b", []), ("c", None)]
    items = spark.createDataFrame(rows, schema)
    encoded = encode_items(items)
    decoded = decode_wire(encoded, items.schema)
    expected = decode_items(encoded, items.schema)
    assert decoded.collect() == expected.collect() and decoded.schema == expected.schema
    assert decoded.filter("PK = 'a'").first().lines[0][0] == EXACT
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get") == 2  # one for PK, one for the whole list; there was one for each part
