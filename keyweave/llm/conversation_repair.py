"""Repair of conversation structure by generalised LR parsing with edits.

A talk is ``(s?(ua)+)?`` over the first characters of the roles (system, user, assistant). An LR table
of that grammar drives a graph-structured stack: cells (state, cell below) are shared, so stacks that
are equal are one cell, and of two ways to the same top the one with the smaller (cost, audit) stays.
Between rows roles may be inserted; a row is kept, given another role, or deleted. The audit is the
edits' initials in order (Keep, Rerole, Delete, Insert).

Rows are dealt out by range of (conversation, turn, role, text) and cut into blocks of bounded size. A
conversation that lies within one task and one block is parsed there. A block of any other is parsed
from every stack the grammar can reach, which gives a small table (from, to) -> (cost, audit); the
tables of one conversation are chained afterwards by costs and ranks of audits. So no task holds a
conversation, however long; a chain holds about a kilobyte for a block.

Defined results: rows go by turn, nulls first, and within a turn by role, the text's first 32
characters, its length and its hash; a null role or text counts as one
space; a null conversation id is a conversation; repeated rows are all kept as input and later ones
are duplicates; an empty role has no first character and cannot be kept; an empty table gives no
rows; other columns are not read. Equality of rows in different blocks goes by sha256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import stored, table, worker_store
from keyweave.llm.registry import query

#: Edit costs; a truncated row that is not deleted adds TRUNCATED.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Roles that edits can give, by first character.
ROLES = {"u": "user", "a": "assistant"}
GRAMMAR = [("talk", ""), ("talk", "T"), ("talk", "sT"), ("T", "ua"), ("T", "Tua")]
#: A block ends with the row that fills it.
BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 20
#: Class strings of whole conversations whose parse a worker keeps.
CACHE_TALKS = 100_000
_WHITE = " \t\n\v\f\r"


class Automaton:
    """LR(0) states of the grammar; a state's reductions are tried for every symbol, as GLR does."""

    def __init__(self, grammar: list[tuple[str, str]]):
        self.rules = [("^", grammar[0][0]), *grammar]
        heads = {head for head, _ in grammar}
        bodies = [(0, (grammar[0][0],))] + [(n, tuple(body)) for n, (_, body) in enumerate(grammar, 1)]
        self.bodies = dict(bodies)

        def closed(items: frozenset) -> frozenset:
            found, todo = set(items), list(items)
            while todo:
                rule, dot = todo.pop()
                if dot < len(self.bodies[rule]) and self.bodies[rule][dot] in heads:
                    for n, (head, _) in enumerate(self.rules):
                        if n and head == self.bodies[rule][dot] and (n, 0) not in found:
                            found.add((n, 0))
                            todo.append((n, 0))
            return frozenset(found)

        states, self.go = [closed(frozenset({(0, 0)}))], []
        for state in states:  # grows while it runs
            self.go.append({})
            for symbol in sorted({self.bodies[r][d] for r, d in state if d < len(self.bodies[r])}):
                after = closed(frozenset((r, d + 1) for r, d in state if self.bodies[r][d : d + 1] == (symbol,)))
                if after not in states:
                    states.append(after)
                self.go[-1][symbol] = states.index(after)
        self.reductions = [[r for r, d in sorted(state) if r and d == len(self.bodies[r])] for state in states]
        self.accepting = next(n for n, state in enumerate(states) if (0, 1) in state)


class StackGraph:
    """Cells (state, cell below), each made once; the answers for a cell are worked out once."""

    def __init__(self, automaton: Automaton):
        self.lr = automaton
        self.cells: list[tuple[int, int]] = []
        self.number: dict[tuple[int, int], int] = {}
        self.bottom = self.cell(0, -1)
        self._shifted: dict[tuple[int, str], list[int]] = {}
        self._accepts: dict[int, bool] = {}

    def cell(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self.number:
            self.number[key] = len(self.cells)
            self.cells.append(key)
        return self.number[key]

    def reduced(self, top: int) -> list[int]:
        """The cell and all cells that reductions make of it."""
        found, todo = [], [top]
        while todo:
            cell = todo.pop()
            if cell in found:
                continue
            found.append(cell)
            for rule in self.lr.reductions[self.cells[cell][0]]:
                below = cell
                for _ in self.lr.bodies[rule]:
                    below = self.cells[below][1]
                goal = self.lr.go[self.cells[below][0]].get(self.lr.rules[rule][0])
                if goal is not None:
                    todo.append(self.cell(goal, below))
        return found

    def shifted(self, top: int, symbol: str) -> list[int]:
        key = (top, symbol)
        if key not in self._shifted:
            goals = [(self.lr.go[self.cells[c][0]].get(symbol), c) for c in self.reduced(top)]
            self._shifted[key] = [self._settled(self.cell(goal, c)) for goal, c in goals if goal is not None]
        return self._shifted[key]

    def _settled(self, cell: int) -> int:
        """Reduces while the state can do nothing else, so that fewer stacks differ."""
        while True:
            state, _ = self.cells[cell]
            rules = self.lr.reductions[state]
            if len(rules) != 1 or self.lr.go[state] or not self.lr.bodies[rules[0]]:
                return cell
            below = cell
            for _ in self.lr.bodies[rules[0]]:
                below = self.cells[below][1]
            goal = self.lr.go[self.cells[below][0]].get(self.lr.rules[rules[0]][0])
            if goal is None or goal == self.lr.accepting:
                return cell
            cell = self.cell(goal, below)

    def accepts(self, top: int) -> bool:
        if top not in self._accepts:
            self._accepts[top] = any(self.cells[c][0] == self.lr.accepting for c in self.reduced(top))
        return self._accepts[top]

    def reachable(self, symbols: str, most: int = 64) -> list[int]:
        """Every stack between two rows. The grammar recurses on the left only, so they are few."""
        found = [self.bottom]
        for top in found:  # grows while it runs
            for symbol in symbols:
                found += [c for c in self.shifted(top, symbol) if c not in found]
            if len(found) > most:
                raise ValueError("the grammar nests: its stacks have no bound")
        return sorted(found)


Ways = dict[int, tuple[int, str, str]]


class Repairer:
    """Parses strings of row classes; see ``row_class``."""

    def __init__(self):
        self.graph = StackGraph(Automaton(GRAMMAR))
        self.stacks = self.graph.reachable("sua")
        self.talks: dict[str, tuple[int, str, str]] = {}

    def inserted(self, ways: Ways) -> Ways:
        """The ways with any number of inserted roles after them."""
        found, todo = dict(ways), list(ways)
        while todo:
            top = todo.pop()
            cost, audit, out = found[top]
            for symbol in ROLES:
                for goal in self.graph.shifted(top, symbol):
                    way = (cost + INSERT, audit + "I", out + symbol)
                    if goal not in found or way[:2] < found[goal][:2]:
                        found[goal] = way
                        todo.append(goal)
        return found

    def after(self, ways: Ways, row: str) -> Ways:
        """The ways one row further: equal tops merge by the smaller (cost, audit)."""
        found: Ways = {}

        def offer(top: int, cost: int, audit: str, out: str) -> None:
            known = found.get(top)
            if known is None or (cost, audit) < known[:2]:
                found[top] = (cost, audit, out)

        symbol, extra = row.lower(), TRUNCATED if row.isupper() else 0
        for top, (cost, audit, out) in self.inserted(ways).items():
            offer(top, cost + DELETE, audit + "D", out)
            if row == "D":
                continue
            for goal in self.graph.shifted(top, symbol):
                offer(goal, cost + KEEP + extra, audit + "K", out + symbol)
            for role in ROLES:
                if role != symbol:
                    for goal in self.graph.shifted(top, role):
                        offer(goal, cost + REROLE + extra, audit + "R", out + role)
        return found

    def run(self, rows: str, start: int) -> Ways:
        ways: Ways = {start: (0, "", "")}
        for row in rows:
            ways = self.after(ways, row)
        return ways

    def finished(self, ways: Ways) -> tuple[int, str, str]:
        return min(way for top, way in self.inserted(ways).items() if self.graph.accepts(top))

    def talk(self, rows: str) -> tuple[int, str, str]:
        """Cost, audit and resulting roles of a whole conversation."""
        found = self.talks.get(rows)
        if found is None:
            if len(self.talks) >= CACHE_TALKS:
                self.talks.clear()
            found = self.talks[rows] = self.finished(self.run(rows, self.graph.bottom))
        return found

    def relation(self, rows: str) -> list[tuple[int, int, int, int, str, str]]:
        """From every stack: (start, stop, cost, rank of the audit, audit, roles)."""
        found = [(s, t, *way) for s in self.stacks for t, way in self.run(rows, s).items()]
        rank = {audit: n for n, audit in enumerate(sorted({x[3] for x in found}))}
        return [(s, t, cost, rank[audit], audit, out) for s, t, cost, audit, out in found]


def _repairer() -> Repairer:
    store = worker_store()
    if "repairer" not in store:
        store["repairer"] = Repairer()
    return store["repairer"]


def fault(role: str, text: str, seen: bool) -> str:
    """First fault of a row: b(lank), d(uplicate), t(runcated) or none."""
    solid = text.rstrip(_WHITE)
    return "b" if not solid else "d" if seen else "" if solid[-1] in ".!?" else "t"


def row_class(role: str, found: str) -> str:
    """One letter: D must be deleted; else the role's first character (x if the grammar has none such), in capitals if truncated."""
    if found in ("b", "d"):
        return "D"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return letter.upper() if found else letter


def row_digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def turn_gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


BLOCK = (
    "conv_id long, part int, seq int, whole boolean, roles array<string>, texts array<string>, digests array<binary>, "
    "low long, high long, turns long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, made string, before long"
)
_STRINGS = pa.list_(pa.string())
_LONGS = ("low", "high", "turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
BLOCK_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_())]
    + [("roles", _STRINGS), ("texts", _STRINGS), ("digests", pa.list_(pa.binary()))]
    + [(c, pa.int64()) for c in _LONGS]
    + [("audit", pa.string()), ("made", pa.string()), ("before", pa.int64())]
)


class _Run:
    """Rows of one conversation as far as they lie in one block."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.roles, self.texts, self.chars = conv_id, [], [], [], 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)

    def full(self) -> bool:
        return len(self.texts) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def row(self, part: int, seq: int, whole: bool) -> dict:
        turns = {t for t in self.turns if t is not None}
        low, high = (min(turns), max(turns)) if turns else (None, None)
        row = {"conv_id": self.conv_id, "part": part, "seq": seq, "whole": whole, "roles": self.roles, "texts": self.texts}
        row |= {"low": low, "high": high, "turns": len(turns), "illegal": illegal_pairs([r[:1] for r in self.roles]), "before": 0}
        if not whole:
            return row | {"digests": [row_digest(r, t) for r, t in zip(self.roles, self.texts)]}
        faults = block_faults(self.roles, self.texts, list(zip(self.roles, self.texts)), set())
        cost, audit, made = _repairer().talk("".join(map(row_class, self.roles, faults)))
        return row | counted(faults) | {"gaps": turn_gaps(low, high, len(turns)), "cost": cost, "audit": audit, "made": made}


def block_faults(roles: list[str], texts: list[str], keys: list, earlier: set) -> list[str]:
    """Faults of a block's rows, given what earlier blocks of the conversation hold."""
    seen, out = set(earlier), []
    for role, text, key in zip(roles, texts, keys):
        out.append(fault(role, text, key in seen))
        seen.add(key)
    return out


def counted(faults: list[str]) -> dict[str, int]:
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t")}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def blocks(conversations: DataFrame) -> DataFrame:
    """Stored blocks of (conv_id, turn, role, text); whole conversations are already repaired."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, run, begun_here, ready, chars = TaskContext.get().partitionId(), 0, None, False, [], 0
        for batch in batches:
            for conv_id, turn, role, text in zip(*[c.to_pylist() for c in batch.columns[:4]]):
                if run is not None and (run.conv_id != conv_id or run.full()):
                    ends = run.conv_id != conv_id
                    ready.append(run.row(part, seq, whole=begun_here and ends))
                    chars += run.chars
                    seq += 1
                    # The first run of a task may have begun in the task before.
                    begun_here = ends
                    run = None
                if run is None:
                    run = _Run(conv_id)
                run.add(turn, role, text)
                if chars >= BLOCK_CHARS:
                    yield _batch(ready, BLOCK_ARROW)
                    ready, chars = [], 0
        if run is not None:
            ready.append(run.row(part, seq, whole=False))  # may go on in the next task
        if ready:
            yield _batch(ready, BLOCK_ARROW)

    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    # The beginning, length and hash stand for the text: range bounds hold no whole texts. Copies of one row
    # are told apart by their place in the input, so that many of them are dealt out, too.
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 32), F.length("text"), F.xxhash64("text")]
    dealt = rows.withColumn("spread", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    ranges = dealt.repartitionByRange(*keys, "spread").sortWithinPartitions(*keys)
    return stored(ranges.select("conv_id", "turn", "role", "text").mapInArrow(cut, BLOCK), "talks")


RELATION = (
    "conv_id long, part int, seq int, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long, starts array<int>, stops array<int>, costs array<long>, ranks array<int>, "
    "sizes array<int>, audits array<string>, mades array<string>"
)
_INTS, _BIGS = pa.list_(pa.int32()), pa.list_(pa.int64())
RELATION_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in ("low", "high", "turns")]
    + [("starts", _INTS), ("stops", _INTS), ("costs", _BIGS), ("ranks", _INTS), ("sizes", _INTS), ("audits", _STRINGS), ("mades", _STRINGS)]
)


def relations(split: DataFrame) -> DataFrame:
    """Stored tables (from, to) -> (cost, audit) of the blocks of conversations in several blocks."""
    held = split.select("conv_id", F.struct("part", "seq").alias("at"), F.explode(F.array_distinct("digests")).alias("digest"))
    first = held.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("at").alias("first_at"))
    earlier = (
        held.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
        .filter(F.col("first_at") < F.col("at"))
        .groupBy("at.part", "at.seq")
        .agg(F.collect_list("digest").alias("earlier"))  # at most a block's rows
    )

    def related(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = _repairer()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                faults = block_faults(row["roles"], row["texts"], row["digests"], set(row["earlier"] or ()))
                found = repairer.relation("".join(map(row_class, row["roles"], faults)))
                columns = list(zip(*found))
                yield _batch(
                    [
                        {k: row[k] for k in ("conv_id", "part", "seq", "illegal", "low", "high", "turns")}
                        | counted(faults)
                        | {"first": row["roles"][0][:1], "last": row["roles"][-1][:1]}
                        | dict(zip(("starts", "stops", "costs", "ranks", "audits", "mades"), columns))
                        | {"sizes": [len(made) for made in columns[5]]}
                    ],
                    RELATION_ARROW,
                )

    needed = ["conv_id", "part", "seq", "illegal", "low", "high", "turns", "roles", "texts", "digests"]
    return stored(split.select(*needed).join(earlier, ["part", "seq"], "left").mapInArrow(related, RELATION), "talk_relations")


CHOICE = "part int, seq int, pick int, tail string, tail_made string, before long, " + ", ".join(
    f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
)


def choices(found: DataFrame) -> DataFrame:
    """For each block of a chained conversation which entry of its table is taken, with the conversation's totals."""

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        repairer = _repairer()
        group = group.sort_values(["part", "seq"])
        rows = list(group.itertuples(index=False))
        ways, back = {repairer.graph.bottom: (0, 0)}, []
        for row in rows:
            offers: dict[int, tuple] = {}
            for i, (s, t, cost, rank) in enumerate(zip(row.starts, row.stops, row.costs, row.ranks)):
                if s in ways:
                    before, order = ways[s]
                    offer = (before + int(cost), order, int(rank), i, int(s))
                    if t not in offers or offer[:3] < offers[t][:3]:
                        offers[int(t)] = offer
            # Audits of equally many rows: none is a beginning of another, so they compare part by part.
            place = {x: n for n, x in enumerate(sorted({o[1:3] for o in offers.values()}))}
            ways = {t: (o[0], place[o[1:3]]) for t, o in offers.items()}
            back.append({t: (o[3], o[4]) for t, o in offers.items()})
        ends = [
            (cost + way[0], order, way[1], way[2], t)
            for t, (cost, order) in ways.items()
            for way in _endings(repairer, t)
        ]
        cost, _, tail, made, top = min(ends)
        picks = []
        for steps in reversed(back):
            pick, top = steps[top]
            picks.append(pick)
        picks.reverse()
        turns = illegal = 0
        low = high = last = None
        for row in rows:
            illegal += int(row.illegal) + (last is not None and last + row.first not in ("su", "ua", "au"))
            last = row.last
            if row.turns:
                turns += int(row.turns) - (high is not None and int(row.low) == high)
                low, high = int(row.low) if low is None else low, int(row.high)
        out, before = [], 0
        for n, (row, pick) in enumerate(zip(rows, picks)):
            final = n == len(rows) - 1
            out.append((row.part, row.seq, pick, tail if final else "", made if final else "", before))
            before += int(row.sizes[pick])
        frame = pd.DataFrame(out, columns=["part", "seq", "pick", "tail", "tail_made", "before"])
        totals = {c: int(group[c].sum()) for c in ("blank", "duplicate", "truncated")}
        return frame.assign(gaps=turn_gaps(low, high, turns), illegal=illegal, cost=cost, **totals)[[f.split()[0] for f in CHOICE.split(", ")]]

    zero = {c: F.coalesce(c, F.lit(0)) for c in ("low", "high")}  # ``turns`` is 0 where they are null
    small = found.drop("audits", "mades").withColumns(zero).withColumn("conv", F.col("conv_id"))
    return stored(small.groupBy("conv").applyInPandas(chain, CHOICE), "talk_choices")


def _endings(repairer: Repairer, top: int) -> list[tuple[int, str, str]]:
    ways = repairer.inserted({top: (0, "", "")})
    return [way for t, way in ways.items() if repairer.graph.accepts(t)]


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired blocks: those that are whole conversations, and those of chained ones.

    Both have conv_id, part, seq, roles, texts, audit, made (first characters of the resulting roles),
    before (resulting rows of earlier blocks) and the conversation's counts.
    """
    cut = blocks(conversations)
    split = cut.filter("NOT whole")
    found = relations(split)
    chosen = choices(found)
    taken = found.select("part", "seq", "audits", "mades").join(chosen, ["part", "seq"])
    done = (
        split.select("conv_id", "part", "seq", "roles", "texts")
        .join(taken, ["part", "seq"])
        .withColumn("audit", F.concat(F.get("audits", "pick"), "tail"))
        .withColumn("made", F.concat(F.get("mades", "pick"), "tail_made"))
    )
    return cut.filter("whole").select(*DONE), done.select(*DONE)


DONE = ["conv_id", "part", "seq", "roles", "texts", "audit", "made", "before", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def edited(roles: list[str], texts: list[str], audit: str, made: str) -> Iterator[tuple[str, str, str]]:
    """Role, text and edit of each resulting row."""
    row, result = 0, iter(made)
    for edit in audit:
        if edit == "I":
            yield ROLES[next(result)], "", "I"
            continue
        if edit != "D":
            symbol = next(result)
            yield (roles[row] if edit == "K" else ROLES[symbol]), texts[row], edit
        row += 1


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit (K, R or I)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = list(edited(row["roles"], row["texts"], row["audit"], row["made"]))
                n = len(found)
                columns = list(zip(*found)) if found else [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["conv_id"]] * n, pa.int64()), pa.array(range(row["before"], row["before"] + n), pa.int64())]
                    + [pa.array(c, pa.string()) for c in columns],
                    ["conv_id", "position", "role", "text", "edit"],
                )

    whole, chained = repair(conversations)
    needed = ["conv_id", "roles", "texts", "audit", "made", "before"]
    return whole.select(*needed).unionByName(chained.select(*needed)).mapInArrow(
        rows, "conv_id long, position long, role string, text string, edit string"
    )


VERDICT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def verdicts(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost, audit and the digest of its repaired ``role:text`` lines.

    A digest is a sequence by nature: blocks of a chained conversation stream through one task in order.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("conv_id", *counts)] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
        current, audits, digest, empty = None, [], hashlib.sha256(), True
        for batch in batches:
            ready = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if current is not None and current["conv_id"] != row["conv_id"]:
                    ready.append(_verdict(current, counts, audits, digest))
                    audits, digest, empty = [], hashlib.sha256(), True
                current = {c: row[c] for c in ("conv_id", *counts)}
                audits.append(row["audit"])
                for role, text, _ in edited(row["roles"], row["texts"], row["audit"], row["made"]):
                    digest.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode())
                    empty = False
            if ready:
                yield _batch(ready, schema)
        if current is not None:
            yield _batch([_verdict(current, counts, audits, digest)], schema)

    whole, chained = repair(conversations)
    needed = ["conv_id", "roles", "texts", "audit", "made", *counts]
    order = ["conv_id", "part", "seq"]
    streamed = chained.repartition("conv_id").sortWithinPartitions(*order)
    return whole.select(*needed).mapInArrow(digests, VERDICT).unionByName(streamed.select(*needed).mapInArrow(digests, VERDICT))


def _verdict(current: dict, counts: list[str], audits: list[str], digest) -> dict:
    return current | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with known faults put in, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes its end marks, 3 repeats it, 4 makes its role user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role, draw = F.coalesce("text", space), F.coalesce("role", space), F.col("draw")
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("draw"))
    return rows.filter(draw != 0).select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = verdicts(damaged(given))
    every = given.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("conv").alias("conv_id"),
        *zeros,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
