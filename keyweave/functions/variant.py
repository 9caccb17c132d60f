"""Sparse items as VARIANT: attributes are stored once, by name, and read one path at a time.

An item of a wide collection holds few of all its attributes. As a VARIANT it carries only those, and a
reader names the attribute and its type; no schema of the whole item is parsed. Items in the typed form
(S, N, BOOL, L, M, NULL; see ``codec``) are read the same way, with numbers exactly as written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.functions.codec import _plain, wire_type
from keyweave.functions.sparse import drop_empty


def _step(name: str) -> str:
    """One step of a path, quoted, so that any attribute name will do."""
    if "'" in name and '"' in name:
        raise ValueError(f"an attribute name with both kinds of quotes has no path: {name}")
    return f'["{name}"]' if "'" in name else f"['{name}']"


def path(*names: str) -> str:
    return "$" + "".join(map(_step, names))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_variant(df: DataFrame, keep: Sequence[str] = ("PK", "SK"), name: str = "item") -> DataFrame:
    """``keep`` as columns and every other present attribute in one VARIANT; NULLs and empty lists are left out."""
    others = [c for c in df.columns if c not in keep]
    return drop_empty(df).select(*keep, F.parse_json(F.to_json(F.struct(*others))).alias(name))


def attribute(item: Column | str, name: str | Sequence[str], dtype: str | T.DataType) -> Column:
    """A typed attribute (or a nested one, by the names on its way); NULL if absent, an error if of another type."""
    names = [name] if isinstance(name, str) else list(name)
    return F.variant_get(_col(item), path(*names), _ddl(dtype))


def attribute_names(item: Column | str) -> Column:
    """Names of the attributes that the item holds, sorted."""
    return F.array_sort(F.map_keys(F.variant_get(_col(item), "$", "map<string,variant>")))


def merged(item: Column | str, changes: Column | str, removed: Column | str | None = None) -> Column:
    """The item with attributes put over it and the names in ``removed`` taken out."""
    whole = "map<string,variant>"
    old, new = F.variant_get(_col(item), "$", whole), F.variant_get(_col(changes), "$", whole)
    old = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    both = F.map_concat(old, new)
    if removed is not None:
        gone = F.coalesce(_col(removed), F.array().cast("array<string>"))
        both = F.map_filter(both, lambda k, _: ~F.array_contains(gone, k))
    return F.to_variant_object(both)


def wire(item: Column | str) -> Column:
    """An encoded item (JSON text of typed values) as VARIANT."""
    return F.parse_json(_col(item))


def wire_attribute(item: Column, names: Sequence[str], dtype: T.DataType) -> Column:
    """One attribute of an encoded item in its declared type; ``names`` leads to it through nested maps.

    Numbers are cast from their text to the declared type, so a long id keeps all its digits.
    """
    steps = [names[0]]
    for n in names[1:]:
        steps += ["M", n]
    return _read(item, path(*steps), dtype)


def _read(item: Column, at: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.variant_get(item, f"{at}{_step('BOOL')}", "boolean")
    if isinstance(dtype, T.NumericType):
        return F.variant_get(item, f"{at}{_step('N')}", "string").cast(dtype)
    if isinstance(dtype, T.ArrayType):
        # A list is read by one cast: a path for each part would walk through every element again.
        tagged = wire_type(dtype)
        return _plain(F.struct(F.variant_get(item, f"{at}{_step('L')}", _quoted(tagged["L"].dataType)).alias("L")), dtype, None)
    if isinstance(dtype, T.MapType):
        entries = F.variant_get(item, f"{at}{_step('M')}", "map<string,variant>")
        return F.transform_values(entries, lambda _, v: _read(v, "$", dtype.valueType))
    if isinstance(dtype, T.StructType):
        inner = f"{at}{_step('M')}"
        fields = F.struct(*[_read(item, inner + _step(f.name), f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(F.variant_get(item, inner, "variant").isNotNull(), fields)
    return F.variant_get(item, f"{at}{_step('S')}", "string").cast(dtype)


def decode_wire(df: DataFrame, schema: T.StructType, item: str = "item", keep: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` read from encoded items; attributes that are not in it are not looked at."""
    parsed = df.withColumn("__variant", wire(item))
    return parsed.select(*keep, *[wire_attribute(F.col("__variant"), [f.name], f.dataType).alias(f.name) for f in schema.fields])


def _quoted(dtype: T.DataType) -> str:
    """The type as text with every field name quoted."""
    if isinstance(dtype, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_quoted(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_quoted(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{_quoted(dtype.keyType)},{_quoted(dtype.valueType)}>"
    return dtype.simpleString()


def _ddl(dtype: str | T.DataType) -> str:
    return dtype if isinstance(dtype, str) else dtype.simpleString()
