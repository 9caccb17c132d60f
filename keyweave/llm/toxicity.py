"""Toxicity by a weighted finite-state grammar over clauses.

A word becomes a symbol (insult, threat, target, negation, report, or other) with a weight; marks end
a clause. Four transducers read the symbols, each passing its output to the next: *negation* weakens
what follows within three words, *report* weakens the rest of a clause after a verb of saying,
*threat* needs a target near it, *target* strengthens an insult aimed at someone, before or after
it. They are composed into one machine once; a clause's weight is what the machine sums over it. So
an isolated word weighs little by itself, and a denied or reported one less.

The insult lexicon is learned from labelled rows: words and word beginnings (for languages that
build long words) that occur in toxic documents and hardly elsewhere, weighted by log odds. Near
copies count once. The document score is a logistic function of its matched clauses, fitted on the
same rows. Both are fitted on at most SAMPLE labelled documents, chosen by hash class of the id;
everything they are applied to is read whole. Only ``text`` is an input of a score.

Defined results: null and empty texts have no clause and get the score of a text without matches; a
null id is hashed as empty text; rows with equal ids are scored each; labels that are null, or
missing for one class, teach nothing and the seed words and default coefficients apply; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import id_remainder, remainder_of, table
from keyweave.llm.registry import query

#: Labelled documents used for fitting, and lexicon entries kept, at most.
SAMPLE = 20_000
ENTRIES = 4_000
#: A lexicon entry occurs in so many toxic documents (clusters of near copies) at least, with such log odds.
LEAST_DOCUMENTS = 4
LEAST_ODDS = 2.5
BEGINNINGS = (3, 4, 5, 6)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# Fixed word lists of the grammar, in four languages.
SEEDS = {
    INSULT: "idiot moron loser scum trash stupid pathetic worthless disgusting clown imbecile dumb "
    "dummkopf abschaum idiota imbécil basura escoria imbécile ordure minable",
    THREAT: "kill hurt destroy smash beat burn shoot stab töten schlagen vernichten tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours yourself u ya they them their he him she her people du dich dir ihr euch sie "
    "tu te toi vous ils elles usted ustedes ti ellos ellas",
    NEGATION: "not no never isn't aren't wasn't don't doesn't didn't won't cannot can't nicht kein keine nie niemals "
    "pas jamais aucun nunca jamás ningún",
    REPORT: "said says say wrote writes called calls quoted reported claims claimed sagte sagt schrieb nannte "
    "dit écrit appelle dijo dice escribió llamó",
}
SEED_WEIGHT = 1.5

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:|\n]")
_MARKS = frozenset(".!?;:|\n")


@dataclass
class Transducer:
    """Arcs (state, symbol) -> (state, symbol, factor, bonus); a missing arc keeps the state and passes the symbol."""

    arcs: dict[tuple, tuple] = field(default_factory=dict)
    start: object = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0, 0.0))

    def then(self, other: "Transducer") -> "Transducer":
        """Composition: the other machine reads what this one writes; factors multiply, bonuses add."""
        start, arcs, todo = (self.start, other.start), {}, [(self.start, other.start)]
        seen = {start}
        while todo:
            a, b = state = todo.pop()
            for symbol in range(7):
                to_a, middle, f, x = self.step(a, symbol)
                to_b, out, g, y = other.step(b, middle)
                arcs[state, symbol] = ((to_a, to_b), out, f * g, x + y)
                if (to_a, to_b) not in seen:
                    seen.add((to_a, to_b))
                    todo.append((to_a, to_b))
        return Transducer(arcs, start)


def negation(scope: int = 3, factor: float = 0.25) -> Transducer:
    arcs = {}
    for left in range(scope + 1):
        arcs[left, NEGATION] = (scope, NEGATION, 1.0, 0.0)
        arcs[left, END] = (0, END, 1.0, 0.0)
        for symbol in (OTHER, TARGET, REPORT):
            arcs[left, symbol] = (max(0, left - 1), symbol, 1.0, 0.0)
        for symbol in (INSULT, THREAT):
            arcs[left, symbol] = (max(0, left - 1), symbol, factor if left else 1.0, 0.0)
    return Transducer(arcs)


def report(factor: float = 0.4) -> Transducer:
    arcs = {(0, REPORT): (1, REPORT, 1.0, 0.0), (1, END): (0, END, 1.0, 0.0)}
    arcs |= {(1, s): (1, s, factor, 0.0) for s in (INSULT, THREAT)}
    return Transducer(arcs)


def threat(reach: int = 3, alone: float = 0.0) -> Transducer:
    """A threat becomes an insult-like match only when a target follows within ``reach`` words."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, THREAT] = (reach, OTHER, alone, 0.0)
        arcs[left, END] = (0, END, 1.0, 0.0)
        arcs[left, TARGET] = (0, TARGET, 1.0, SEED_WEIGHT if left else 0.0)
        for symbol in (OTHER, REPORT, NEGATION, INSULT):
            arcs[left, symbol] = (max(0, left - 1), symbol, 1.0, 0.0)
    return Transducer(arcs)


def target(factor: float = 1.5, after: float = 0.5) -> Transducer:
    """An insult after a target in the clause counts more; a target after an insult adds once."""
    return Transducer(
        {
            (0, TARGET): (1, TARGET, 1.0, 0.0),
            (1, INSULT): (1, INSULT, factor, 0.0),
            (0, INSULT): (2, INSULT, 1.0, 0.0),
            (2, TARGET): (1, TARGET, 1.0, after),
            (1, END): (0, END, 1.0, 0.0),
            (2, END): (0, END, 1.0, 0.0),
        }
    )


def grammar() -> Transducer:
    return negation().then(report()).then(threat()).then(target())


def clean_word(word: str) -> str:
    return word.replace("’", "'")


def entries_of(words: set[str]) -> set[str]:
    """Lexicon entries a document can support: its words, and the beginnings of longer ones (marked ``*``)."""
    found = set(words)
    for word in words:
        found.update(word[:n] + "*" for n in BEGINNINGS if len(word) > n)
    return found


class Lexicon(dict):
    """Symbol and weight of any word; looked up once, kept for later (bounded)."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned
        self.seeds = {w: s for s, words in SEEDS.items() for w in words.split()}

    def __missing__(self, word: str):
        if len(self) > 300_000:
            self.clear()
        if word in _MARKS:
            found = (END, 0.0)
        else:
            key = clean_word(word)
            weight = max(
                self.learned.get(key, 0.0), *(self.learned.get(key[:n] + "*", 0.0) for n in BEGINNINGS if len(key) > n), 0.0
            ) if len(key) > BEGINNINGS[0] else self.learned.get(key, 0.0)
            symbol = self.seeds.get(key, OTHER)
            if weight:
                found = (INSULT, weight)
            else:
                found = (symbol, SEED_WEIGHT if symbol in (INSULT, THREAT) else 0.0)
        self[word] = found
        return found


class Matcher:
    def __init__(self, learned: dict[str, float]):
        self.lexicon, self.machine = Lexicon(learned), grammar()

    def clauses(self, text: str | None) -> tuple[list[tuple[float, int, int]], int]:
        """(weight, first word, end) of the matched clauses, and the number of words and marks."""
        words = _TOKEN.findall((text or "").lower())
        tags = list(map(self.lexicon.__getitem__, words))
        if not any(s == INSULT or s == THREAT for s, _ in tags):
            return [], len(words)
        step, state, weight, begin, found = self.machine.arcs, self.machine.start, 0.0, 0, []
        tags.append((END, 0.0))
        for i, (symbol, own) in enumerate(tags):
            state, out, factor, bonus = step[state, symbol]
            weight += bonus + (own * factor if out == INSULT else 0.0)
            if symbol == END:
                if weight > 0:
                    found.append((weight, begin, i))
                weight, begin = 0.0, i + 1
        return found, len(words)

    def features(self, text: str | None) -> list[float]:
        found, n = self.clauses(text)
        total = sum(w for w, _, _ in found)
        return [math.log1p(total), max((w for w, _, _ in found), default=0.0) / 4, math.log1p(len(found)), 50 * total / (n + 50)]


#: Used when there is nothing to fit.
DEFAULT = np.array([-3.0, 1.5, 1.0, 1.0, 0.1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method on a penalised likelihood; the first coefficient is the constant."""
    if not 0 < y.sum() < len(y):
        return DEFAULT
    x = np.hstack([np.ones((len(x), 1)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass(frozen=True)
class Model:
    learned: dict[str, float]
    beta: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows whose crc32(doc_id as text) mod ``modulus`` is not ``held_out``."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & (id_remainder(F.col("doc_id"), modulus) != held_out)
    )
    every = max(1, usable.count() // sample)
    chosen = (
        usable.withColumn("order", F.xxhash64("doc_id"))
        .filter(F.pmod("order", F.lit(every)) == 0)
        .groupBy("doc_id", "order")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy("order", "doc_id")
        .limit(sample)
        .select("doc_id", "toxic")
    )
    # The sample's bound makes the broadcast small; the texts stay where they are.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's entries once per cluster: documents with one smallest four-word hash are near copies."""
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                words = _TOKEN.findall((text.as_py() or "").lower())
                key = min((xxhash.xxh64_intdigest(" ".join(words[i : i + 4])) for i in range(max(1, len(words) - 3))))
                mine = sorted(entries_of({clean_word(w) for w in words if w not in _MARKS}))
                yield pa.RecordBatch.from_pydict(
                    {"cluster": pa.array([key - 2**63], pa.int64()), "toxic": pa.array([toxic.as_py()], pa.int32()), "entries": [mine]}
                )

    seen = texts.mapInArrow(clusters, "cluster long, toxic int, entries array<string>")
    first = seen.groupBy("cluster").agg(F.max_by("entries", F.size("entries")).alias("entries"), F.max("toxic").alias("toxic"))
    sizes = dict(texts.groupBy("toxic").count().collect())
    toxic, clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    rows = (
        first.select(F.explode("entries").alias("entry"), "toxic")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .filter(F.col("t") >= LEAST_DOCUMENTS)
        .withColumn("odds", odds)
        .filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("t"), F.desc("odds"), "entry")
        .limit(ENTRIES)
        .collect()
    )
    learned = {r.entry: min(5.0, r.odds) for r in rows}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(learned)
        for batch in batches:
            x = [matcher.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": x, "toxic": batch.column(1)})

    table_ = texts.mapInArrow(measured, "x array<double>, toxic int").groupBy("x", "toxic").count().collect()
    if not table_:
        return Model(learned, DEFAULT)
    x = np.repeat([r["x"] for r in table_], [r["count"] for r in table_], axis=0)
    y = np.repeat([r["toxic"] for r in table_], [r["count"] for r in table_])
    return Model(learned, fit_logistic(np.array(x, float), y.astype(float)))


SCORES = "doc_id long, held_out boolean, score double, predicted int, n_clauses long, strongest string"


def score(docs: DataFrame, model: Model, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Score, prediction, number of matched clauses and the words of the strongest one, for every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.learned)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "held_out", "score", "predicted", "n_clauses", "strongest")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                found, n = matcher.clauses(text)
                total = sum(w for w, _, _ in found)
                best = max(found, default=None)
                x = [1, math.log1p(total), best[0] / 4 if best else 0.0, math.log1p(len(found)), 50 * total / (n + 50)]
                p = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(np.dot(x, model.beta))))))
                out["doc_id"].append(doc_id)
                out["held_out"].append(remainder_of(doc_id, modulus) == held_out)
                out["score"].append(p)
                out["predicted"].append(int(p >= 0.5))
                out["n_clauses"].append(len(found))
                words = _TOKEN.findall(text.lower())[best[1] : best[2]] if best else None
                out["strongest"].append(" ".join(words) if best else None)
            out["predicted"] = pa.array(out["predicted"], pa.int32())
            out["strongest"] = pa.array(out["strongest"], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return docs.select("doc_id", "text").mapInArrow(scored, SCORES)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
