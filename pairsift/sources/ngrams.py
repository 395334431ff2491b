"""Readers for n-gram count files and the parser of their lines.

A line is ``ngram <tab> year <tab> match_count [<tab> anything else]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.functions.text import computed, token_list, whole_number
from pairsift.sources.sequence import read_sequence as read_sequence


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain or compressed text files as one ``value`` column."""
    return spark.read.text(path)


def line_fields(value: Column) -> Column:
    """The fields of a line as an array, all after the third in one."""
    return F.split(value, "\t", 4)


def field(fields: Column, position: int) -> Column:
    """One of the fields; NULL if the line is too short."""
    return F.get(fields, F.lit(position))


def parse_ngrams(lines: DataFrame) -> DataFrame:
    """``value`` lines as ``ngram string, year int, cnt bigint``.

    Lines with fewer than three fields, or whose year or count is not a whole
    number, are left out; :mod:`pairsift.operators.stats` counts them.
    """
    fields = F.col("fields")
    return computed(
        lines.select(line_fields(F.col("value")).alias("fields")),
        field(fields, 0).alias("ngram"),
        whole_number(field(fields, 1), "int").alias("year"),
        whole_number(field(fields, 2), "bigint").alias("cnt"),
    ).where("year is not null and cnt is not null")


def split_bigrams(ngrams: DataFrame) -> DataFrame:
    """``t1, t2, year, cnt`` of the n-grams that are two tokens long."""
    tokens = token_list(F.col("ngram")).alias("tokens")
    return (
        computed(ngrams, tokens, kept=("year", "cnt"))
        .where(F.size("tokens") == 2)
        .select(
            F.get("tokens", F.lit(0)).alias("t1"),
            F.get("tokens", F.lit(1)).alias("t2"),
            "year",
            "cnt",
        )
    )
