"""Typed attribute values (S, N, BOOL, L, M, NULL) written and read by column expressions.

The expressions are built once from the schema, so each row is encoded inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _tagged(value: Column, dtype: T.DataType, nested: bool) -> Column:
    """Struct with the one type tag of ``dtype``; NULL for an absent value outside lists."""
    if isinstance(dtype, T.BooleanType):
        tag, body = "BOOL", value
    elif isinstance(dtype, T.NumericType):
        tag, body = "N", value.cast("string")
    elif isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        tag, body = "L", F.transform(value, lambda item: _tagged(item, element, True))
        if not nested:
            value = F.when(F.size(value) > 0, value)
    elif isinstance(dtype, T.StructType):
        tag = "M"
        body = F.struct(*[_tagged(value[f.name], f.dataType, False).alias(f.name) for f in dtype.fields])
    elif isinstance(dtype, T.MapType):
        tag = "M"
        body = F.transform_values(
            F.map_filter(value, lambda _, v: v.isNotNull()),
            lambda _, v: _tagged(v, dtype.valueType, False),
        )
    else:
        tag, body = "S", value.cast("string")
    present = F.when(value.isNotNull(), body).alias(tag)
    if nested:
        return F.struct(F.when(value.isNull(), F.lit(True)).alias("NULL"), present)
    return F.when(value.isNotNull(), F.struct(present))


def encode_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The item as a struct of tagged attributes."""
    wanted = set(columns or df.columns)
    return F.struct(
        *[_tagged(F.col(f.name), f.dataType, False).alias(f.name) for f in df.schema.fields if f.name in wanted]
    )


def encode_items(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = (), name: str = "item") -> DataFrame:
    """One JSON text per item; NULL attributes and empty lists are left out."""
    return df.select(*keep, F.to_json(encode_struct(df, columns)).alias(name))


def wire_type(dtype: T.DataType, nested: bool = False) -> T.StructType:
    """Schema of the JSON that ``_tagged`` writes for ``dtype``."""
    if isinstance(dtype, T.BooleanType):
        tag = T.StructField("BOOL", T.BooleanType())
    elif isinstance(dtype, T.NumericType):
        tag = T.StructField("N", T.StringType())
    elif isinstance(dtype, T.ArrayType):
        tag = T.StructField("L", T.ArrayType(wire_type(dtype.elementType, True)))
    elif isinstance(dtype, T.StructType):
        tag = T.StructField("M", wire_schema(dtype))
    elif isinstance(dtype, T.MapType):
        tag = T.StructField("M", T.MapType(T.StringType(), wire_type(dtype.valueType)))
    else:
        tag = T.StructField("S", T.StringType())
    null = [T.StructField("NULL", T.BooleanType())] if nested else []
    return T.StructType([*null, tag])


def wire_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, wire_type(f.dataType)) for f in schema.fields])


def _plain(value: Column, dtype: T.DataType, number: str | None) -> Column:
    """The value under the tag; numbers in the declared type, or all of them as ``number``."""
    if isinstance(dtype, T.BooleanType):
        return value["BOOL"]
    if isinstance(dtype, T.NumericType):
        return value["N"].cast(number or dtype)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value["L"], lambda item: _plain(item, dtype.elementType, number))
    if isinstance(dtype, T.StructType):
        inner = value["M"]
        fields = F.struct(*[_plain(inner[f.name], f.dataType, number).alias(f.name) for f in dtype.fields])
        return F.when(inner.isNotNull(), fields)
    if isinstance(dtype, T.MapType):
        return F.transform_values(value["M"], lambda _, v: _plain(v, dtype.valueType, number))
    return value["S"] if isinstance(dtype, T.StringType) else value["S"].cast(dtype)


def decode_items(
    df: DataFrame, schema: T.StructType, item: str = "item", keep: tuple[str, ...] = (), number: str | None = None
) -> DataFrame:
    """Read encoded items back into columns; ``schema`` is the schema they were encoded from, or a part of it.

    Numbers get their declared type, so a long id keeps all its digits; ``number="double"`` reads all of them alike.
    """
    parsed = df.withColumn("__wire", F.from_json(F.col(item), wire_schema(schema)))
    return parsed.select(
        *keep, *[_plain(F.col("__wire")[f.name], f.dataType, number).alias(f.name) for f in schema.fields]
    )


def decode_attribute(item: Column | str, name: str, tag: str) -> Column:
    """One scalar attribute without parsing the whole item."""
    text = F.get_json_object(item, f"$.{name}.{tag}")
    return text.cast("double") if tag == "N" else text.cast("boolean") if tag == "BOOL" else text
