"""Scores of pairs that carry ``c1``, ``c2``, ``c12`` and ``n``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsift.functions.likelihood import g2, likelihood_terms

COUNTS = ("c1", "c2", "c12", "n")


def with_score(pairs: DataFrame) -> DataFrame:
    """``decade, w1, w2, score``."""
    score = g2(*map(F.col, COUNTS))
    return pairs.select("decade", "w1", "w2", score.alias("score"))


def with_terms(pairs: DataFrame) -> DataFrame:
    """``decade, w1, w2`` and the four log-likelihoods behind the score."""
    terms = likelihood_terms(*map(F.col, COUNTS))
    return pairs.select("decade", "w1", "w2", *(c.alias(name) for name, c in terms.items()))
