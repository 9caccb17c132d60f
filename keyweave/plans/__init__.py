from keyweave.plans.build import build, build_all
from keyweave.plans.store import COLLECTIONS, TABLES

__all__ = ["COLLECTIONS", "TABLES", "build", "build_all"]
