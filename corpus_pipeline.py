"""Training data out of the documents table, in five stages.

Every stage gets what the one before has kept, with the columns of ``documents``; the
last one returns the encoded texts' digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairsift.llm import byte_bpe, exact_dedup, language, mixing, simhash
from pairsift.llm.common import kept, table

RANKS = "byte_bpe_50k.tiktoken"


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learnt; others go."""
    return language.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.survivors(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.survivors(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sampled_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document left."""
    path = public_tokenizers.path(RANKS)
    return byte_bpe.encode_digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", in_a_language),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

# The stages learn, hash in ways that DuckDB lacks and encode: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
