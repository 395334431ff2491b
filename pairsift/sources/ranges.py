"""Pair tables in key order over files, and look-ups that open few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.operators.filters import any_of

KEY = ("decade", "w1", "w2")


def write_ranges(pairs: DataFrame, folder: str, files: int) -> None:
    """Stores pairs sorted by decade, first and second word over about ``files`` files.

    Every file has a range of keys of its own, and ``files`` beside the rows lists the
    least and the largest one of each. A key's rows are few (one in a table of sums), so
    ranges are of like size however often a word occurs.
    """
    spark = pairs.sparkSession
    ordered = pairs.repartitionByRange(files, *KEY).sortWithinPartitions(*KEY)
    ordered.write.mode("overwrite").parquet(f"{folder}/rows")
    rows = spark.read.schema(pairs.schema).parquet(f"{folder}/rows")
    key = F.struct(*KEY)
    bounds = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("least"), F.max(key).alias("most"), F.count("*").alias("rows")
    )
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{folder}/files")


def may_hold(word: str, decade: int | None = None) -> Column:
    """Whether a file's range reaches pairs that begin with a word."""
    least, most = F.col("least"), F.col("most")
    if decade is not None:
        one = F.struct(F.lit(decade).alias("decade"), F.lit(word).alias("w1"))
        first, last = (F.struct(end["decade"].alias("decade"), end["w1"].alias("w1")) for end in (least, most))
        return (first <= one) & (one <= last)
    inside = (least["w1"] <= word) & (most["w1"] >= word)
    # A file over two decades has the end of one and the beginning of the other; one over
    # more has some decade whole.
    ends = (least["w1"] <= word) | (most["w1"] >= word) | (most["decade"] - least["decade"] > 10)
    return F.when(least["decade"] == most["decade"], inside).otherwise(ends)


def pairs_of(spark: SparkSession, folder: str, words: list[str], decade: int | None = None) -> DataFrame:
    """The stored pairs that begin with one of a few words, in a decade or in all.

    Only files whose range may hold one are opened, and in these Parquet's own bounds
    skip row groups.
    """
    bounds = spark.read.parquet(f"{folder}/files")
    wanted = bounds.where(any_of([may_hold(word, decade) for word in words])).select("file")
    names = [row["file"] for row in wanted.collect()]  # few of the files, for few words
    like = spark.read.parquet(f"{folder}/rows")
    if not names:
        return like.limit(0)
    rows = spark.read.schema(like.schema).parquet(*(f"{folder}/rows/{name}" for name in names))
    found = rows.where(F.col("w1").isin(words))
    return found if decade is None else found.where(F.col("decade") == decade)
