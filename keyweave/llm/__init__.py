"""Operators for the data of language models. Nothing else in the library imports this package."""

from keyweave.llm import bpe, conversation_repair, decontaminate, exact_topk, katz, line_dedup  # noqa: F401  (registration)
from keyweave.llm import near_copies, personal_data, repeated_spans, shard_balance, token_files  # noqa: F401
from keyweave.llm import token_links, toxicity  # noqa: F401
from keyweave.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
