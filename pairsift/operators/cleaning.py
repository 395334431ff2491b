"""Row filters: clean words, and pairs free of stop words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsift.functions.text import clean_token, computed, decade_of


def clean_unigrams(ngrams: DataFrame) -> DataFrame:
    """``decade, w, cnt`` of the n-grams that are one clean word.

    Stop words stay: they count towards the words of a decade.
    """
    words = computed(
        ngrams,
        decade_of(F.col("year")).alias("decade"),
        clean_token(F.col("ngram")).alias("w"),
        F.col("cnt"),
    )
    return words.where("decade is not null and w is not null")


def clean_bigrams(bigrams: DataFrame) -> DataFrame:
    """``decade, w1, w2, cnt`` of the bigrams whose two tokens are clean words."""
    pairs = computed(
        bigrams,
        decade_of(F.col("year")).alias("decade"),
        clean_token(F.col("t1")).alias("w1"),
        clean_token(F.col("t2")).alias("w2"),
        F.col("cnt"),
    )
    return pairs.where("decade is not null and w1 is not null and w2 is not null")


def one_of(column: str, words: Iterable[str]) -> Column:
    """Whether a column of clean words holds one of ``words``.

    Written as SQL: a column object for each of some hundred words takes longer
    to build than to run on a small input. Words with a quote or a backslash are
    left out, which no clean word has.
    """
    listed = ", ".join(f"'{word}'" for word in words if not {"'", "\\"} & set(word))
    return F.expr(f"{column} IN ({listed})") if listed else F.lit(False)


def without_stopwords(pairs: DataFrame, words: Iterable[str]) -> DataFrame:
    """Pairs neither of whose words is in ``words``, upper or lower case.

    One test on the number of stop words in a pair, not one on each word: that
    Catalyst would also apply to the word counts a pair is joined with, and as
    the decade totals need the counts of all words, count the words twice.
    """
    words = [word.lower() for word in words]
    found = [one_of(word, words).cast("int") for word in ("w1", "w2")]
    return pairs.where(found[0] + found[1] == 0)


def without_stopword_rows(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The same against a table with a column ``w``, for lists of any length.

    There is no broadcast hint: Spark broadcasts the table if it is small by its
    own measure and shuffles otherwise, where it can split a frequent word. Only the
    two words decide, so sum pairs first and test the sums.
    """
    columns = pairs.columns
    for word in ("w1", "w2"):
        pairs = pairs.join(words.select(F.lower("w").alias(word)), word, "left_anti")
    return pairs.select(*columns)
