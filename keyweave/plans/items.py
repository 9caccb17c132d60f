"""The common frame of an item: keys, entity type, attributes, stamps, index keys."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def now_stamp() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def item(
    df: DataFrame,
    entity: str,
    pk: Column,
    sk: Column,
    attributes: dict[str, Column],
    stamp: str,
    index1: tuple[Column, Column] | None = None,
    index2: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Project ``df`` to items. One stamp serves the whole run. An empty index key is absent, and its sort key with it."""
    columns = [pk.alias("PK"), sk.alias("SK"), F.lit(entity).alias("EntityType")]
    columns += [value.alias(name) for name, value in attributes.items()]
    for name, keys in (("GSI1", index1), ("GSI2", index2)):
        if keys is not None:
            columns += [F.when(keys[0] != "", k).alias(f"{name}{part}") for part, k in zip(("PK", "SK"), keys)]
    columns += [F.lit(stamp).alias("CreatedAt"), F.lit(stamp).alias("UpdatedAt")]
    return df.select(*columns)


def same(*names: str) -> dict[str, Column]:
    """Attributes copied from columns of the same name."""
    return {name: F.col(name) for name in names}
