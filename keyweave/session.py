"""Session helpers: the shared folder for materialised steps and size checks taken from the optimizer."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting (a test on one machine) gets a temporary folder; on a
    cluster no other machine would see it, so its absence is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured is None:
        configured = context.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines reach")
        configured = tempfile.mkdtemp(prefix="keyweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused, so nothing has to be overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder. Like ``materialize``, but the rounds of a loop do not multiply
    the estimated size, which here is that of the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; many joins can make it a number beyond all bounds."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except ValueError:  # more digits than Python reads
        return 1 << 62


def fits_broadcast(df: DataFrame, factor: int = 1) -> bool:
    """True when ``factor`` times the size of ``df`` is below the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) * factor <= limit


def exceeds_partition(df: DataFrame) -> bool:
    """True when ``df`` is larger than one shuffle partition should be (AQE's advisory size).

    Below that size no key can make a task too big, however its rows are distributed.
    """
    limit = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    return estimated_bytes(df) > _bytes(limit)


def _bytes(text: str) -> int:
    """Size in bytes of a setting such as ``64MB``, ``64m`` or ``67108864b``."""
    units = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    number = text.strip().lower().removesuffix("b")
    return int(number[:-1]) * units[number[-1]] if number[-1:] in units else int(number)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
