import json

import pytest
from pyspark.sql import functions as F

from keyweave.functions import (
    attribute_count,
    composite_key,
    drop_empty,
    full_name,
    index_key,
    is_linked,
    number,
    search_key,
    try_number,
    with_defaults,
)
from keyweave.functions.codec import decode_attribute, decode_items, encode_items


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_keys(spark):
    df = spark.createDataFrame([(7, "Abc", None)], "id bigint, name string, none string")
    assert one(df, composite_key("ARTIST", "id")) == "ARTIST#7"
    assert one(df, composite_key("ARTIST", "none")) is None
    assert one(df, index_key("name", "ALBUM")) == "ALBUM#ABC"
    assert one(df, search_key("none")) == "SEARCH#"
    assert one(df, index_key("name")) == "ABC"


@pytest.mark.parametrize(
    "first, last, expected",
    [("Ann", "Lee", "Ann Lee"), (None, "Lee", "Lee"), ("Ann", None, "Ann"), (None, None, ""), ("\t Ann", "Lee \n", "Ann Lee")],
)
def test_full_name(spark, first, last, expected):
    df = spark.createDataFrame([(first, last)], "first string, last string")
    assert one(df, full_name("first", "last")) == expected


def test_links_and_numbers(spark):
    df = spark.createDataFrame([(0,), (None,), (5,)], "link bigint")
    assert [r[0] for r in df.select(F.coalesce(is_linked("link"), F.lit(False))).collect()] == [False, False, True]
    text = spark.createDataFrame([("1.5",), (None,)], "t string")
    assert [r[0] for r in text.select(number("t")).collect()] == [1.5, 0.0]
    bad = spark.createDataFrame([("x",)], "t string")
    assert one(bad, try_number("t")) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(number("t")).collect()


def test_missing_column_is_not_null(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, name string")
    filled = with_defaults(df, {"name": ("string", ""), "composer": ("string", ""), "bytes": ("bigint", 0)})
    assert filled.first().asDict() == {"id": 1, "name": None, "composer": "", "bytes": 0}


def test_sparse(spark):
    df = spark.createDataFrame([(1, []), (None, [2])], "id bigint, items array<bigint>")
    sparse = drop_empty(df)
    assert [r["items"] for r in sparse.collect()] == [None, [2]]
    assert [r[0] for r in sparse.select(attribute_count(sparse.columns)).collect()] == [1, 1]


ITEM = (
    "text string, n bigint, x double, yes boolean, none string, empty array<string>, "
    "words array<string>, lines array<struct<a:bigint,b:string>>, map map<string,bigint>, nested struct<p:string,q:double>"
)


def item(spark):
    row = ("a", 1, 0.5, True, None, [], ["x", None], [(1, None), (2, "z")], {"k": 3, "gone": None}, ("p", None))
    return spark.createDataFrame([row], ITEM)


def test_encode(spark):
    encoded = json.loads(encode_items(item(spark)).first()["item"])
    assert encoded == {
        "text": {"S": "a"},
        "n": {"N": "1"},
        "x": {"N": "0.5"},
        "yes": {"BOOL": True},
        "words": {"L": [{"S": "x"}, {"NULL": True}]},
        "lines": {"L": [{"M": {"a": {"N": "1"}}}, {"M": {"a": {"N": "2"}, "b": {"S": "z"}}}]},
        "map": {"M": {"k": {"N": "3"}}},
        "nested": {"M": {"p": {"S": "p"}}},
    }


def test_decode_gives_the_item_back(spark):
    source = item(spark)
    back = decode_items(encode_items(source), source.schema).first()
    assert (back["text"], back["n"], back["x"], back["yes"], back["none"]) == ("a", 1.0, 0.5, True, None)
    assert back["empty"] is None and back["words"] == ["x", None]
    assert [tuple(line) for line in back["lines"]] == [(1.0, None), (2.0, "z")]
    assert back["map"] == {"k": 3.0} and tuple(back["nested"]) == ("p", None)


def test_large_numbers_decode_to_the_same_value(spark):
    df = spark.createDataFrame([(12345678.9, 0.99)], "a double, b double")
    encoded = encode_items(df)
    found = encoded.select(decode_attribute("item", "a", "N"), decode_attribute("item", "b", "N")).first()
    assert tuple(found) == (12345678.9, 0.99)
