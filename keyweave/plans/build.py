"""Build named collections. Sources of collections that were not asked for are never read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from keyweave.plans.catalog import music_catalog
from keyweave.plans.customer import customer_data
from keyweave.plans.employee import employee_data
from keyweave.plans.items import now_stamp
from keyweave.plans.playlist import playlist_data

BUILDERS = {
    "music_catalog": music_catalog,
    "customer_data": customer_data,
    "playlist_data": playlist_data,
    "employee_data": employee_data,
}


def build(
    names: Iterable[str], tables: dict[str, DataFrame], stamp: str | None = None, lists: bool = True
) -> dict[str, DataFrame]:
    """Collections by name. Without ``lists`` embedded children are counted and left out, which is all that keys,
    counts, orders and checks of attributes need."""
    names = list(names)
    unknown = sorted(set(names) - set(BUILDERS))
    if unknown:
        raise ValueError(f"Unknown collections: {', '.join(unknown)}")
    stamp = stamp or now_stamp()
    more = {} if lists else {"customer_data": {"lists": False}}
    return {name: BUILDERS[name](tables, stamp, **more.get(name, {})) for name in names}


def build_all(tables: dict[str, DataFrame], stamp: str | None = None, lists: bool = True) -> dict[str, DataFrame]:
    return build(BUILDERS, tables, stamp, lists)
