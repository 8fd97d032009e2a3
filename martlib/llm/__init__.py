"""Operators for preparing training data, each registered as a query over its whole table."""

from martlib.llm import bpe, codes, language, mincut, mixing, negatives, ngram_join, pivots, preferences, repetition, secrets, sharding, token_files  # noqa: F401 - importing registers the queries
from martlib.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
