"""Heterogeneous entities in one sparse collection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_entities(entities: Sequence[DataFrame]) -> DataFrame:
    """Union by name; an attribute an entity does not have is NULL, i.e. absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), entities)
