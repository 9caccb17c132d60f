from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from keyweave.llm import exact_topk as m
from keyweave.llm.exact_topk import ORACLE, bounds, op3_exact_topk, top_k

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(tuple(r) for r in op3_exact_topk(spark, SF).collect()) == sorted(db.sql(ORACLE).fetchall())


def brute(rows, k):
    valid = {
        i: [math.floor(256 * x) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, a in valid.items():
        if q % 3 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid.items() if i != q and len(a) == len(b))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits", [1, 4, 6])
def test_copies_ties_and_odd_vectors(spark, monkeypatch, bits):
    monkeypatch.setattr(m, "CELL_ROWS", 16)
    monkeypatch.setattr(m, "QUERY_ROWS", 5)
    rng = random.Random(bits)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, rows[0][1]) for i in range(120, 170)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [math.nan] * 4), (203, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(204, [1.0, 2.0]), (207, [3.0, 1.0]), (210, []), (5, rows[5][1])]
    data = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    found = top_k(data, F.col("vec_id") % 3 == 0, k=4, bits=bits).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 4)


def test_empty_and_overflow(spark):
    data = spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")
    assert top_k(data.limit(0), F.lit(True)).count() == 0
    with pytest.raises(OverflowError):
        top_k(data.selectExpr("vec_id", "array(1e8D) AS embedding"), F.lit(True))


def test_what_moves_and_stays_grows_with_groups_not_with_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "CELL_ROWS", 8)
    monkeypatch.setattr(m, "QUERY_ROWS", 4)
    kept = {}

    def noted(df, name, stored=m.stored):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(m, "stored", noted)
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(600)]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 3 == 0, k=4).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 4)
    # 75 blocks of the file or more: five bounds or more of each for each of the 200 queries would stay.
    assert kept["cells"].count() >= 75 and kept["bounds"].count() < 200 * 75 * 5 / 2


@pytest.mark.parametrize("limit", ["HELD_BOUNDS", "HELD_QUERIES", "HELD_BYTES", "TASK_PAIRS"])
def test_small_limits_change_nothing(spark, monkeypatch, limit):
    monkeypatch.setattr(m, limit, 64)
    monkeypatch.setattr(m, "CELL_ROWS", 16)
    monkeypatch.setattr(m, "QUERY_ROWS", 5)
    rng = random.Random(limit)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1e5]) * rng.random() for _ in range(3)]) for i in range(90)] + [(100 + i, [float(i)]) for i in range(9)]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 3 == 0, k=3).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 3)


def test_groups():
    assert m.groups(0, 0, 0, 24) == (16, 1)
    for entries, queries, parts in ((2000, 40, 12), (615_384, 12_312, 600), (15_000_000, 300_000, 600), (10, 10_000_000, 24)):
        of_file, of_queries = m.groups(entries, queries, 64, parts)
        assert queries / of_queries <= m.HELD_QUERIES and of_file * of_queries >= min(parts, 16)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v, q = rng.integers(-200, 200, (50, 8)), rng.integers(-200, 200, (7, 8)).astype(float)
    width = np.full(8, 13.0)
    low, high = bounds(np.floor((v + 200) / 13), np.full(8, -200.0), width, q)
    exact = q @ v.T
    assert (low <= exact).all() and (exact <= high).all()
