"""The corpus pipeline: toxic documents go, repeated lines go, one document of each group of near
copies stays, documents that hold benchmark items go, and what is left becomes token ids.

Each stage works on all that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.bpe import round_trip
from keyweave.llm.corpus import stored, table
from keyweave.llm.decontaminate import find_items
from keyweave.llm.line_dedup import drop_repeated_lines
from keyweave.llm.near_copies import near_copies
from keyweave.llm.toxicity import fit, score

#: Documents whose ids are taken out are listed first; a list of at most so many is broadcast.
BROADCAST_ROWS = 1_000_000


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id is not in ``gone`` (a null id is compared like any other)."""
    gone = gone.select(F.col("doc_id").alias("_gone")).distinct()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned on the labels; a document predicted toxic goes."""
    judged = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, stored(judged.filter("predicted = 1").select("doc_id"), "toxic"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are equal or one edit apart the first stays; a document with nothing left goes."""
    cleaned = drop_repeated_lines(docs, distance=1)  # as test_pipeline.py fixes it; None takes the edits of a line's length
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, similarity 0.8: the smallest document of each group stays."""
    return _without(docs, stored(near_copies(docs, shingle=5, percent=80).filter("NOT kept").select("doc_id"), "copies"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that holds a benchmark item, also with other numbers and names, goes."""
    return _without(docs, stored(find_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id"), "leaks"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, and a check of their decoding."""
    done = round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.selectExpr(
        "doc_id", "cast(octet_length(ids) div 4 as long) AS n_tokens", "sha2(ids, 256) AS ids_sha256", "decoded_sha256"
    )


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the learned grammar, the sketches or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
