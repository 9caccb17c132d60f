"""Repair of conversations, against a plain search written from the rules."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from keyweave.llm import conversation_repair as cr
from keyweave.llm.conversation_repair import damaged, op13_conversation_repair, repaired_rows, verdicts

WHITE = " \t\n\v\f\r"
#: Finite automaton of (s?(ua)+)?: 0 nothing yet, 1 system, 2 user, 3 pair complete.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(WHITE)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Cheapest (cost, audit) and the resulting rows, by states of the finite automaton."""
    best = {0: (0, "", ())}
    for n in range(len(rows) + 1):
        changed = True
        while changed:  # inserts
            changed = False
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    to = STEP.get((state, role[0]))
                    way = (cost + 5, audit + "I", (*out, (role, "")))
                    if to is not None and (to not in best or way[:2] < best[to][:2]):
                        best[to], changed = way, True
        if n == len(rows):
            break
        (role, text), fault, after = rows[n], faults[n], {}
        for state, (cost, audit, out) in best.items():
            ways = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways.append((STEP.get((state, role[:1])), (cost + more, audit + "K", (*out, (role, text)))))
                for other in ("user", "assistant"):
                    ways.append((STEP.get((state, other[0])), (cost + more + 1, audit + "R", (*out, (other, text)))))
            for to, way in ways:
                if to is not None and (to not in after or way[:2] < after[to][:2]):
                    after[to] = way
        best = after
    return min(best[s] for s in (0, 3) if s in best)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def plain_verdicts(rows, convs=None):
    groups = {c: [] for c in (convs if convs is not None else [r[0] for r in rows])}
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    found = []
    for conv, part in groups.items():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(), len(r[2])))
        said = [r[1:] for r in part]
        faults = plain_faults(said)
        cost, audit, out = plain_repair(said, faults)
        turns = {r[0] for r in part if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0))


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(rng, convs, most):
    roles = ["user", "assistant", "system", "tool", "agent", "usher", None]
    texts = ["Yes.", "No!", "Why?", "cut off", " \t", "", None, "Done. ", "a b c.", "x"]
    out = []
    for conv in convs:
        turn = 0
        for _ in range(rng.randint(0, most)):
            turn += rng.choice([1, 1, 1, 2])
            out.append((conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Turn {turn} of {conv}."))
    return out


def test_cheapest_of_all_edits():
    """Every sequence of edits with up to two inserts a gap, for all short conversations."""
    repairer = cr.Repairer()
    legal = re.compile(r"(s?(ua)+)?")
    ways = {}
    for letter in "uasxUAD":
        more = 5 if letter.isupper() else 0
        ways[letter] = [(2, "D", "")]
        if letter != "D":
            ways[letter] += [(more, "K", letter.lower()), (1 + more, "R", "u"), (1 + more, "R", "a")]
    gap = [(5 * len(x), "I" * len(x), x) for n in range(3) for x in map("".join, itertools.product("ua", repeat=n))]
    for n in range(3):
        for classes in itertools.product("uasxUAD", repeat=n):
            choices = [gap]
            for letter in classes:
                choices += [ways[letter], gap]
            expected = min(
                (sum(x[0] for x in way), "".join(x[1] for x in way), made)
                for way in itertools.product(*choices)
                if legal.fullmatch(made := "".join(x[2] for x in way))
            )
            assert repairer.talk("".join(classes)) == expected, classes


def test_stacks_are_few():
    assert len(cr.Repairer().stacks) == 8


def test_grammar_without_bound_is_refused():
    nested = cr.StackGraph(cr.Automaton([("S", ""), ("S", "uSa")]))
    with pytest.raises(ValueError):
        nested.reachable("ua")


def test_verdicts_as_by_plain_search(spark):
    rng = random.Random(11)
    rows = random_rows(rng, range(60), 12) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (3, None, "system", "First.")]
    df = spark.createDataFrame([(r[3], *r[:3], 1, "c") for r in rows], "text string, conv_id long, turn long, role string, part int, audit string")
    assert found(verdicts(df)) == plain_verdicts(rows)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_chained_blocks_as_by_plain_search(spark, monkeypatch, size):
    """Conversations far longer than a block: tables of the blocks, chained."""
    monkeypatch.setattr(cr, "BLOCK_ROWS", size)
    rows = random_rows(random.Random(size), range(4), 60)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(verdicts(df.repartition(5))) == plain_verdicts(rows)


def test_repeated_rows_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_ROWS", 16)
    rows = [(1, 5, "user", "Same.")] * 300 + [(1, 6, "assistant", "y" * 20000 + "."), (2, None, None, None)]
    rows += [(3, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)]
    assert found(verdicts(spark.createDataFrame(rows, SCHEMA))) == plain_verdicts(rows)


def test_rows_of_the_repair(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_ROWS", 5)
    rows = random_rows(random.Random(2), range(12), 20)
    result = {}
    for conv, position, role, text, edit in sorted(map(tuple, repaired_rows(spark.createDataFrame(rows, SCHEMA)).collect())):
        assert position == len(result.setdefault(conv, []))
        result[conv].append((role, text, edit))
    for conv, *_, audit, digest in plain_verdicts(rows):
        got = result.get(conv, [])
        assert "".join(e for *_, e in got) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in got).encode()).hexdigest() == digest


def test_empty_table(spark):
    assert verdicts(spark.createDataFrame([], SCHEMA)).collect() == []
    assert damaged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_as_by_plain_search(spark, tmp_path):
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select(*[f.split()[0] for f in SCHEMA.split(", ")]).collect()]
    given += [(None, None, None, None), (-5, 3, "user", None), (777777, 1, "", "No role.")]
    spark.createDataFrame(given, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    result = found(op13_conversation_repair(spark, str(tmp_path)))
    assert result == plain_verdicts(plain_damage(given), [r[0] for r in given])
