"""Counts per decade. Spark sums within each task before it shuffles, so a word
or pair with very many lines reaches its reducer as one row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """``decade, w1, w2, c12``: how often each pair occurs in a decade."""
    return pairs.groupBy("decade", "w1", "w2").agg(F.sum("cnt").alias("c12"))


def unigram_counts(words: DataFrame) -> DataFrame:
    """``decade, w, c``: how often each word occurs in a decade."""
    return words.groupBy("decade", "w").agg(F.sum("cnt").alias("c"))


def decade_totals(unigrams: DataFrame) -> DataFrame:
    """``decade, n``: the number of words in each decade, stop words included."""
    return unigrams.groupBy("decade").agg(F.sum("c").alias("n"))


def in_key_order(pairs: DataFrame) -> DataFrame:
    """Pairs in the order of decade, first and second word (by UTF-8 bytes)."""
    return pairs.orderBy("decade", "w1", "w2")
