"""Every registered query against its SQL, on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import TABLES, compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from keyweave.workload import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    relation = db.execute(ORACLES[name])
    columns = [c[0] for c in relation.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, relation.fetchall(), columns) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["keyweave.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_entry_without_an_optional_part(missing):
    """In a process of its own, as modules that are loaded already would hide what is missing."""
    code = f"""import sys; sys.modules[{missing!r}] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__), timeout=120)
    assert done.returncode == 0, done.stderr
    n, with_sql = map(int, done.stdout.split())
    assert n >= len(QUERIES) and with_sql >= len(ORACLES)
