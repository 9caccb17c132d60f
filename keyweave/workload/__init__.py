"""The registered queries over the benchmark tables, each with its check in plain SQL."""

from keyweave.workload.registry import ORACLES, QUERIES

from keyweave.workload import access, catalog, checks, collections, loading, primitives  # noqa: E402,F401  (registration)

__all__ = ["ORACLES", "QUERIES"]
