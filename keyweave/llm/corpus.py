"""Helpers that the operators share: tables, stored steps, hash splits and packed integers."""

from __future__ import annotations

import sys
import types
import zlib
import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.session import scratch_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def remainder_of(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def lower_ascii(text: str) -> str:
    """A-Z to a-z, every other character as it is."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def worker_store(owner: str | None = None) -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions of this package reach a worker as code, with fresh globals for every task; what is
    costly to build is kept here instead. An operator with large tables names itself as ``owner``: what
    another one has left in the worker goes then, as one stage does not need the tables of an earlier one.
    """
    module = sys.modules.setdefault("_keyweave_llm_worker", types.ModuleType("_keyweave_llm_worker"))
    store = module.__dict__.setdefault("store", {})
    if owner is not None and store.get("owner") != owner:
        store.clear()
        store["owner"] = owner
    return store


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (a multiply-xorshift finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x
