"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs once to warm up and then twice; the better time counts. Results are computed in
full and written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from keyweave.operators import access
from keyweave.plans.build import build_all
from keyweave.plans.store import INDEX1, INDEX2
from keyweave.sources.tables import CollectionStore
from keyweave.workload import QUERIES
from keyweave.workload.adapter import STAMP, store_tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "music_catalog", "customer_data", "playlist_data", "employee_data",
    "embed_children", "bridge_enrich", "fk_orphans", "keyed_upsert", "batch_assignment",
    "encode_items", "decode_items", "validation_verdict", "progress_status", "catalog_counts",
    "org_chart_depth", "incremental_load",
    "track_three_way_join", "customer_history_join",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best(run, repeats: int = 2) -> float:
    times = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def stored_access(spark: SparkSession) -> dict[str, float]:
    """Access patterns on stored, bucketed collections and their indexes."""
    store = CollectionStore(spark, prefix="bench_")
    for name, items in build_all(store_tables(spark, SF_DIR), STAMP).items():
        store.create(name, items, force=True)
    for index in (INDEX1, INDEX2):
        store.add_index("music_catalog", index)
    index1, index2 = (store.read_index("music_catalog", index) for index in (INDEX1, INDEX2))
    catalog, customers = store.read("music_catalog"), store.read("customer_data")
    return {
        "get_stored": best(lambda: store.get("music_catalog", "TRACK#77", "METADATA")),
        "partition_stored": best(lambda: access.query_partition(customers, "CUSTOMER#77")),
        "prefix_stored": best(lambda: access.query_partition(customers, "CUSTOMER#77", "INVOICE#")),
        "index1_stored": best(lambda: access.query_index(index1, INDEX1, "ALBUM#7")),
        "index1_plain": best(lambda: access.query_index(catalog, INDEX1, "ALBUM#7")),
        "index2_stored": best(lambda: access.search_name(index2, INDEX2, "small ring")),
    }


def main() -> None:
    spark = session()
    times = {name: best(lambda n=name: QUERIES[n](spark, SF_DIR)) for name in HEADLINE}
    times.update(stored_access(spark))
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
