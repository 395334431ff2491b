"""Joins that bring word counts and decade totals to the pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(pairs: DataFrame, table: DataFrame, keys: list[str], in_place: bool = False) -> DataFrame:
    """``pairs`` left-joined to ``table``, which has each combination of keys once.

    Nothing is multiplied, but one word or decade may own a large share of the
    pairs. There is no broadcast hint: adaptive execution broadcasts the table if
    it turns out small once computed. Otherwise it can split the partition of a
    large key, as long as it sees a plain shuffle on both sides. The tables here
    come out of a ``groupBy`` on the same keys, whose partitions the join would
    take over as they are; comparing a hash of the keys first (it adds nothing to
    the match and is not stored) asks for a shuffle of its own. That one is over
    the smaller side, and lookups in the same table by different columns share it.
    """
    sides = [[F.col(f"{side}.{key}") for key in keys] for side in ("pair", "row")]
    same = F.lit(True) if in_place else F.xxhash64(*sides[0]) == F.xxhash64(*sides[1])
    for left, right in zip(*sides):
        same = same & (left == right)
    found = [f"row.{name}" for name in table.columns if name not in keys]
    return pairs.alias("pair").join(table.alias("row"), same, "left").select("pair.*", *found)


def with_word_count(
    pairs: DataFrame, unigrams: DataFrame, word: str, count: str, in_place: bool = False
) -> DataFrame:
    """``pairs`` with the count of the word in column ``word``; 0 if unknown."""
    counted = unigrams.select("decade", F.col("w").alias(word), F.col("c").alias(count))
    found = look_up(pairs, counted, ["decade", word], in_place)
    return found.select(*pairs.columns, F.coalesce(count, F.lit(0)).alias(count))


def with_totals(pairs: DataFrame, totals: DataFrame, strict: bool = True) -> DataFrame:
    """``pairs`` with ``n``, the number of words in their decade.

    A decade without a total is an error, or gives NULL if not ``strict``.
    """
    n = F.col("n")
    if strict:
        message = F.concat(F.lit("no unigrams for decade "), F.col("decade"))
        n = F.when(n.isNull(), F.raise_error(message)).otherwise(n)
    return look_up(pairs, totals, ["decade"]).select(*pairs.columns, n.alias("n"))
