"""Absent attributes: declared defaults for missing columns, NULL for empty lists, presence counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_defaults(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Add every column of ``defaults`` (name -> type, value) that the source lacks.

    A column that exists keeps its NULLs: a missing column and a NULL value are different things.
    """
    missing = {
        name: F.lit(value).cast(dtype) for name, (dtype, value) in defaults.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def drop_empty(df: DataFrame) -> DataFrame:
    """Turn empty lists into NULL, i.e. into absent attributes."""
    lists = {
        f.name: F.when(F.size(f.name) > 0, F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return df.withColumns(lists) if lists else df


def attribute_count(columns: Iterable[str]) -> Column:
    """How many of the columns hold a value."""
    total = F.lit(0).cast("bigint")
    for name in columns:
        total = total + F.col(name).isNotNull().cast("bigint")
    return total
