"""Makes n-gram lines out of tables of texts.

The driver's tables hold no n-gram counts, so the registered queries count the
n-grams of a text table first and feed the engine the resulting lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsift.functions.text import token_list
from pairsift.sources.sequence import write_sequence as write_sequence

# The documents hold no Hebrew; their letters are put into Hebrew ones.
LATIN = "abcdefghijklmnopqrstuv"
HEBREW = "אבגדהוזחטיכלמנסעפצקרשת"

# Lines of Hebrew words and of stop words among them: n-gram, year, count.
HEBREW_UNIGRAMS = [
    ("תל", 2003, 50), ("אביב", 2003, 60), ("של", 2003, 500), ("דבר", 2001, 90),
    ("ארה״ב", 2005, 70), ("(ירושלים)", 2004, 80), ("העיר", 2004, 40), ("ארה\"ב", 2005, 9),
]
HEBREW_BIGRAMS = [
    ("תל אביב", 2003, 40), ("תל אביב,", 2009, 2), ("של אביב", 2003, 30), ("העיר ירושלים", 2004, 20),
    ("אביב דבר", 2001, 8), ("ארה״ב העיר", 2005, 7), ("ארה\"ב העיר", 2005, 5), ("תל אביב יפו", 2003, 3),
    ("תל אביב", 1995, 6), ("big תל", 2003, 4),
]

# Signs around a token, in the SQL of both engines, and tokens with known results.
DRESSED = (
    "raw", "concat('\"', raw, ',')", "concat(raw, '_NOUN')", "concat('19', raw)",
    f"translate(lower(raw), '{LATIN}', '{HEBREW}')",
    f"concat(translate(lower(raw), '{LATIN}', '{HEBREW}'), '״')",
    f"concat('(', translate(lower(raw), '{LATIN}', '{HEBREW}'), raw)",
)
ODD_TOKENS = [
    "'ve", "I", "19th", "\"Hello,", "_NOUN_", "café", "dog_NOUN", "état", "don't", "x1y",
    "תל", "ארה\"ב", "של", "ארה״ב", "״תל״", "תל-אביב", "שָׁלוֹם", "19", "--",
]


def texts(table: DataFrame, id_column: str) -> DataFrame:
    """``year, tokens`` of each row of a table with an id and a ``text``.

    The year is made up from the id so that the texts fall in twelve decades.
    """
    number = F.col(id_column)
    year = F.lit(1900) + number % 12 * 10 + number % 7
    return table.select(
        year.cast("int").alias("year"), token_list(F.col("text")).alias("tokens")
    )


def _lines(ngrams: DataFrame) -> DataFrame:
    counts = ngrams.groupBy("ngram", "year").agg(F.count("*").alias("cnt"))
    return counts.select(F.concat_ws("\t", "ngram", "year", "cnt").alias("value"))


def unigram_lines(texts_: DataFrame) -> DataFrame:
    """One line per token and year."""
    tokens = texts_.select(F.explode_outer("tokens").alias("ngram"), "year")
    return _lines(tokens.where("ngram != ''"))


def bigram_lines(texts_: DataFrame) -> DataFrame:
    """One line per pair of neighbouring tokens and year."""
    follower = F.slice("tokens", F.lit(2), F.size("tokens"))
    neighbours = F.arrays_zip(F.col("tokens").alias("a"), follower.alias("b"))
    pairs = texts_.select(F.inline(neighbours).alias("a", "b"), "year")
    # The last token has no follower.
    pairs = pairs.where("b is not null")
    # Nearly every pair is new to its task. Sums of a task would be nearly as many as pairs
    # and outgrow its memory, so pairs are dealt out first and summed where they meet. The
    # key is one field of bytes, which holds the smallest rows.
    key = F.concat_ws("\t", F.concat_ws(" ", "a", "b"), "year").cast("binary").alias("key")
    counts = pairs.select(key).repartition("key").groupBy("key").agg(F.count("*").alias("cnt"))
    return counts.select(F.concat_ws("\t", F.col("key").cast("string"), "cnt").alias("value"))


def product_lines(lineitem: DataFrame, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unigram and bigram lines of the two-word part names, by shipping year.

    Line items are summed per part before the join, so a part with a large share
    of them meets its name as one row per year.
    """
    sold = lineitem.groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").alias("qty")
    )
    names = part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    named = (
        sold.join(names, "l_partkey")
        .groupBy("p_name", "year")
        .agg(F.sum("qty").cast("bigint").alias("cnt"))
    )
    words = (
        named.select(F.explode(token_list(F.col("p_name"))).alias("ngram"), "year", "cnt")
        .groupBy("ngram", "year")
        .agg(F.sum("cnt").alias("cnt"))
    )
    line = F.concat_ws("\t", "ngram", "year", "cnt").alias("value")
    return words.select(line), named.withColumnRenamed("p_name", "ngram").select(line)
