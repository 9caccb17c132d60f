"""Shards by differencing, against a plain version of the method and the law itself."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from xxhash import xxh64_intdigest

from keyweave.llm import shard_balance
from keyweave.llm.shard_balance import assign, difference, op11_shard_balance, write_shards


def plain_difference(sizes, parts):
    """Partial partitions as lists of (sum, items), the two of largest spread combined each time."""
    if not sizes:
        return []
    pool = [(n, [(0, [])] * (parts - 1) + [(size, [n])]) for n, size in enumerate(sizes)]
    made = len(sizes)
    while len(pool) > 1:
        pool.sort(key=lambda x: (x[1][0][0] - x[1][-1][0], x[0]))
        (_, a), (_, b) = pool[:2]
        joined = [(a[p][0] + b[parts - 1 - p][0], p, a[p][1] + b[parts - 1 - p][1]) for p in range(parts)]
        joined.sort(key=lambda x: x[:2])
        pool = [*pool[2:], (made, [(s, items) for s, _, items in joined])]
        made += 1
    out = [0] * len(sizes)
    for part, (_, items) in enumerate(pool[0][1]):
        for n in items:
            out[n] = part
    return out


def sums(sizes, labels, parts):
    out = [0] * parts
    for size, label in zip(sizes, labels):
        out[label] += size
    return out


@pytest.mark.parametrize("parts", [1, 2, 3, 8])
def test_differencing_as_by_plain_version(parts):
    rng = random.Random(parts)
    for n in (0, 1, 2, 7, 40, 90):
        sizes = [rng.randint(1, rng.choice([3, 50, 10**6])) for _ in range(n)]
        found = difference(sizes, parts)
        assert sums(sizes, found, parts) == sums(sizes, plain_difference(sizes, parts), parts)


def test_tighter_than_one_by_one():
    """Tighter than giving each item to the smallest part, largest items first."""
    rng = random.Random(9)
    for _ in range(20):
        sizes = [rng.randint(1, 10**6) for _ in range(200)]
        greedy = [0] * 8
        for size in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += size
        found = sums(sizes, difference(sizes, 8), 8)
        assert max(found) - min(found) < max(greedy) - min(greedy)


def test_one_item_beyond_a_fair_share():
    sizes = [9000] + [random.Random(n).randint(1, 10) for n in range(3000)]
    found = sorted(sums(sizes, difference(sizes, 8), 8))
    assert found[-1] == 9000 and found[-2] - found[0] <= 1


def check_law(data, found, shards):
    """data: (doc_id, text) rows; found: doc_id, size, text_crc32, shard, slot."""
    expected = sorted(((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in found) == expected
    slots, order = defaultdict(list), defaultdict(list)
    for r in found:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        order[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0))
    for shard, numbers in slots.items():
        assert sorted(numbers) == list(range(len(numbers)))
        assert [x[1:] for x in sorted(order[shard])] == sorted(x[1:] for x in order[shard])


def of_text(data, found):
    """Shards of each distinct text, by the rows' ids (unique in the data)."""
    texts = dict(data)
    shards = defaultdict(set)
    for r in found:
        shards[texts[r.doc_id] or ""].add(r.shard)
    return shards


def test_query_as_by_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = op11_shard_balance(spark, folder).collect()
    check_law(data, found, 8)
    groups = defaultdict(int)
    for _, text in data:
        groups[sha256((text or "").encode()).digest()] += len((text or "").encode()) + 1
    total = sum(groups.values())
    large = sorted(k for k, n in groups.items() if n * shard_balance.ITEMS >= total)
    bundles = defaultdict(int)
    for k, n in groups.items():
        if n * shard_balance.ITEMS < total:
            bundles[xxh64_intdigest(k, 42) % shard_balance.ITEMS] += n
    sizes = [groups[k] for k in large] + [bundles[b] for b in sorted(bundles)]
    shards = of_text(data, found)
    assert sums([r.size for r in found], [r.shard for r in found], 8) == sums(sizes, plain_difference(sizes, 8), 8)
    assert all(len(s) == 1 for s in shards.values())
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


def test_bundles_and_a_group_of_copies(spark, monkeypatch):
    """Far more groups than items; a third of the rows are copies of one text."""
    monkeypatch.setattr(shard_balance, "ITEMS", 64)
    rng = random.Random(4)
    data = [(n, "copied text " * 20 if n % 3 == 0 else "".join(rng.choices("abc é漢", k=rng.randint(0, 300)))) for n in range(3000)]
    data += [(5000, None), (5001, ""), (5002, "long " * 40000)]
    docs = spark.createDataFrame([(t, i, 7, "c") for i, t in data], "text string, doc_id long, shard int, group string")
    found = assign(docs.repartition(6), 4).collect()
    check_law(data, found, 4)
    shards = of_text(data, found)
    assert all(len(s) == 1 for s in shards.values())
    totals = sorted(sums([r.size for r in found], [r.shard for r in found], 4))
    assert totals[-1] == 1000 * 241  # the copies, beyond a fair share, are on their own
    assert totals[2] - totals[0] <= 0.005 * sum(totals)
    again = assign(docs.repartition(3), 4).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_repeated_rows_nulls_and_empty(spark):
    data = [(1, "a"), (1, "a"), (None, "b"), (None, None), (2, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    check_law(data, assign(docs, 3).collect(), 3)
    check_law([], assign(docs.limit(0), 3).collect(), 3)
    check_law(data, assign(docs, 1).collect(), 1)


def test_written_shards(spark, tmp_path):
    data = [(n, "x" * (n % 17), "kept", n % 2) for n in range(200)] + [(None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, _shard string, `group` int")
    totals = {r.shard: (r.documents, r.bytes) for r in write_shards(docs, str(tmp_path / "out"), 3).collect()}
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, read.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    counted = defaultdict(lambda: [0, 0])
    for r in read.collect():
        counted[r["_shard_"]][0] += 1
        counted[r["_shard_"]][1] += len((r.text or "").encode()) + 1
    assert {k: tuple(v) for k, v in counted.items()} == totals
    assert max(v[1] for v in totals.values()) - min(v[1] for v in totals.values()) <= 200
