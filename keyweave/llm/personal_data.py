"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Column expressions only. Patterns find spans in a text: four base kinds (email, ip, card, phone) that
always stay, and candidates of three further kinds (secret, local_phone, name) that do not overlap
them. On every candidate five labelers vote for, against or not at all:

shape       what the span looks like inside (mix of letters and digits, grouping, capitals)
gazetteer   lists of names, titles, area codes that do not exist
keyword     words before it that announce such data
contrary    words before it that announce something else
company     base data close by in the same text

Expectation-maximisation over the counts of vote patterns of the whole table (at most 3 * 3^5 rows, so
they are collected) estimates how often each labeler is right and how likely each pattern is personal
data. A logistic classifier is trained on those estimates; it is a linear function of kind and votes,
applied as an expression. So texts are read once, and no row is shuffled but the counts.

Positions are in code points, ends exclusive. Defined results: a null text counts as empty; a null id
stays null; rows with equal ids are searched each; an empty table gives no rows and the labelers' prior
weights; other columns are not read. Spans of one kind never overlap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.corpus import stored, table
from keyweave.llm.registry import query

# A match starts where the last one ended or where no character of the class stands before, so a long
# run is tried once; possessive repeats never give characters back, which the patterns never need.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<=(?i:password|passwd|token|secret|apikey|api_key|access_key)\x20{0,2}[=:]\x20{0,2}\x22?)[A-Za-z0-9/+_.-]{8,}+",
    "local_phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?",
}
#: A text without this cannot hold a match.
NEEDS = {
    "email": "@", "ip": ".", "card": "", "phone": "+", "secret": "", "local_phone": "", "name": "",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "local_phone", "name")
KINDS = BASE + ADDED
LABELERS = ("shape", "gazetteer", "keyword", "contrary", "company")
CONTEXT = 40

# Fixed lists of the gazetteer and context labelers.
FIRST_NAMES = "Anna|Maria|John|Mary|James|Peter|Paul|Hans|Pierre|Marie|Juan|Carmen|Luis|Michael|Thomas|David|Sarah|Laura"
KEYWORDS = {
    "secret": r"(?:password|passwd|token|secret|key|login|credential)",
    "local_phone": r"(?:tel|phone|call|fax|mobile|handy|anruf|tél|llam)",
    "name": r"(?:name|dear|contact|signed|regards|sehr geehrte|cher|estimad)",
}
CONTRARY = r"(?:version|isbn|page|figure|chapter|order no|serial|example|sample|dummy|placeholder)"

SPAN = "array<struct<start: int, match: string>>"


def spans(text: Column, kind: str) -> Column:
    """All matches with their places: the lengths of what lies between them, summed up."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    found = F.aggregate(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match"))),
        F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["pos"] + x["gap"] + F.length(x["match"])).alias("pos"),
            F.concat(acc["out"], F.array(F.struct((acc["pos"] + x["gap"]).alias("start"), x["match"].alias("match")))).cast(SPAN).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    possible = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
    return F.when(possible & text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check sum of at most 19 digits."""
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike(r"^0*+(?:[1-9]?[0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = F.lit(0) if no is None else F.when(no, -1).otherwise(0)
    return F.when(yes, 1).otherwise(against)


def votes(kind: str, match: Column, before: Column, company: Column) -> Column:
    letter, digit = match.rlike("[A-Za-z]"), match.rlike("[0-9]")
    shape = {
        "secret": lambda: _vote(letter & digit & (F.length(match) >= 12), ~digit),
        "local_phone": lambda: _vote(match.rlike(r"^(\([0-9]{3}\)\x20|[0-9]{3}([.-])[0-9]{3}\2)"), match.rlike(r"^[0-9]{3}\x20[0-9]{3}\x20")),
        "name": lambda: _vote(match.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}+$")),
    }[kind]()
    gazetteer = {
        "secret": lambda: _vote(F.lit(False), F.lower(match).rlike(r"^(?:changeme|placeholder|example|password|xxxxxxxx+|12345678[0-9]*)$")),
        "local_phone": lambda: _vote(match.rlike(r"^\(?[2-9][0-9]{2}"), match.rlike(r"^\(?[01]")),
        "name": lambda: _vote(match.rlike(rf"\x20(?:{FIRST_NAMES})(?![\p{{L}}])")),
    }[kind]()
    keyword = _vote(before.rlike(KEYWORDS[kind]))
    contrary = F.when(before.rlike(CONTRARY), -1).otherwise(0)
    return F.array(shape, gazetteer, keyword, contrary, _vote(company))


CANDIDATE = "array<struct<kind: int, start: int, end: int, votes: array<int>>>"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all spans of a text: base ones without votes, the others with theirs."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text", *[spans(F.col("text"), k).alias(f"s_{k}") for k in KINDS])

    def passing(k):
        return F.filter(f"s_{k}", lambda x: valid(k, x["match"])).alias(f"s_{k}") if k in BASE else F.col(f"s_{k}")

    rows = rows.select("doc_id", "text", *map(passing, KINDS))
    end = lambda x: x["start"] + F.length(x["match"])

    def base(k):
        return F.transform(
            f"s_{k}",
            lambda x: F.struct(
                F.lit(KINDS.index(k)).alias("kind"), x["start"].alias("start"), end(x).alias("end"), F.lit(None).cast("array<int>").alias("votes")
            ),
        ).cast(CANDIDATE)

    rows = rows.withColumn("base", F.concat(*[base(k) for k in BASE]))

    def added(k):
        free = F.filter(f"s_{k}", lambda x: ~F.exists("base", lambda b: (b["start"] < end(x)) & (x["start"] < b["end"])))

        def voted(x):
            first = F.greatest(F.lit(0), x["start"] - CONTEXT)
            before = F.lower(F.substring(F.col("text"), first + 1, x["start"] - first))
            company = F.exists("base", lambda b: F.abs(b["start"] - x["start"]) <= 200)
            return F.struct(
                F.lit(KINDS.index(k)).alias("kind"), x["start"].alias("start"), end(x).alias("end"), votes(k, x["match"], before, company).alias("votes")
            )

        return F.transform(free, voted).cast(CANDIDATE)

    return rows.select("doc_id", F.concat("base", *[added(k) for k in ADDED]).alias("spans"))


def estimate(patterns: dict[tuple, int], rounds: int = 60) -> dict[tuple, float]:
    """EM over (kind, votes) -> count: how likely each pattern is personal data.

    A labeler is right with its own frequency when it votes; votes are independent given the truth.
    The start trusts every labeler at 0.75 and keeps a pseudo count, which fixes what the classes mean.
    """
    right = [0.75] * len(LABELERS)
    prior = {k: 0.5 for k, _ in patterns}
    belief: dict[tuple, float] = {}
    for _ in range(rounds):
        for (kind, vote), _n in patterns.items():
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(v * math.log(r / (1 - r)) for v, r in zip(vote, right))
            belief[kind, vote] = 1 / (1 + math.exp(-odds))
        for i in range(len(LABELERS)):
            cast = [(n, belief[p] if p[1][i] > 0 else 1 - belief[p]) for p, n in patterns.items() if p[1][i]]
            right[i] = min(0.98, max(0.52, (sum(n * b for n, b in cast) + 7.5) / (sum(n for n, _ in cast) + 10)))
        for kind in prior:
            mine = [(n, belief[p]) for p, n in patterns.items() if p[0] == kind]
            prior[kind] = min(0.95, max(0.05, (sum(n * b for n, b in mine) + 5) / (sum(n for n, _ in mine) + 10)))
    return belief


def train(patterns: dict[tuple, int], rounds: int = 400) -> tuple[list[float], list[float], list[float]]:
    """Weights of kinds, of votes for and of votes against: a logistic classifier on the estimates."""
    belief = estimate(patterns)
    total = sum(patterns.values()) or 1
    kind_w, yes_w, no_w = [0.0] * len(ADDED), [1.0] * len(LABELERS), [-1.0] * len(LABELERS)
    for _ in range(rounds):
        g_kind, g_yes, g_no = [1e-3 * w for w in kind_w], [1e-3 * (w - 1) for w in yes_w], [1e-3 * (w + 1) for w in no_w]
        for (kind, vote), n in patterns.items():
            z = kind_w[kind - len(BASE)] + sum(y * (v > 0) + x * (v < 0) for v, y, x in zip(vote, yes_w, no_w))
            error = n / total * (1 / (1 + math.exp(-z)) - belief[kind, vote])
            g_kind[kind - len(BASE)] += error
            for i, v in enumerate(vote):
                if v > 0:
                    g_yes[i] += error
                elif v < 0:
                    g_no[i] += error
        kind_w = [w - 2 * g for w, g in zip(kind_w, g_kind)]
        yes_w = [w - 2 * g for w, g in zip(yes_w, g_yes)]
        no_w = [w - 2 * g for w, g in zip(no_w, g_no)]
    return kind_w, yes_w, no_w


def find(docs: DataFrame) -> DataFrame:
    """doc_id and accepted spans: array of (kind number in KINDS, start, end), ordered."""
    rows = stored(candidates(docs), "candidates")
    counted = rows.select(F.explode(F.filter("spans", lambda s: s["votes"].isNotNull())).alias("s")).groupBy("s.kind", "s.votes").count()
    patterns = {(r["kind"], tuple(r["votes"])): r["count"] for r in counted.collect()}
    kind_w, yes_w, no_w = train(patterns)

    def weight(s):
        z = F.element_at(F.array(*map(F.lit, [0.0] * len(BASE) + kind_w)), s["kind"] + 1)
        for i in range(len(LABELERS)):
            v = s["votes"][i]
            z = z + F.when(v > 0, yes_w[i]).when(v < 0, no_w[i]).otherwise(0.0)
        return z

    accepted = F.filter("spans", lambda s: s["votes"].isNull() | (weight(s) >= 0))
    ordered = F.array_sort(F.transform(accepted, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return rows.select("doc_id", ordered.alias("spans"))


def _text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@query("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id", *[of_kind(k) for k in BASE], F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans")
    )
