"""What several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.stages import new_folder, staged

# Between words: the ASCII white space that bytes.split() knows as well.
WORD_GAP = r"[\x20\x09-\x0D]+"

# Removes a query's shuffle files as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder and read back.

    Later steps start from the stored table, so a lost executor costs a re-read.
    The shuffles behind it are no longer needed and are removed right away.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return staged(df, new_folder(df.sparkSession, name))
    finally:
        conf.set(CLEANUP, before)


def whole_text(text: str) -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
