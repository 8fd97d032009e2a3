"""A corpus pipeline: from the documents table to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martlib.llm import bpe, language, mixing, ngram_join, secrets
from martlib.session import checkpoint_dir


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; others go."""
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 80 % of the united five-word shingles stays."""
    return ngram_join.keep_first(docs, width=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and their digests after a round trip."""
    return bpe.token_report(docs)


STAGES = [
    ("language", known_languages),
    ("near_duplicates", near_duplicates),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]
# Cross-parsing, the randomness battery and BPE are not SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written as Parquet and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
