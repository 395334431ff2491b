"""Runs a job on some decades after others, so that the disk holds the shuffles of a few at a time.

Words, pairs, totals, scores and ranks of a decade come from its own lines alone. All decades
at once leave every shuffle of the job on disk until it ends, which is many times the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.functions.text import decade_of
from pairsift.stages import staged

# Input that a slice has at most, unless a single decade has more.
SLICE_BYTES = 32 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Slice:
    """Some decades, or (``others``) all but some, rows without a decade among them."""

    decades: tuple[int, ...] = ()
    others: bool = True

    def rows(self, table: DataFrame) -> DataFrame:
        """The rows of a table with a ``year`` that are in these decades."""
        return table.where(self.has(decade_of(F.col("year")))) if self.decades else table

    def has(self, decade: Column) -> Column:
        listed = F.coalesce(decade.isin(*self.decades), F.lit(False))
        return ~listed if self.others else listed


WHOLE = Slice()


def slices_of(texts: Mapping[int | None, int], size: int, most: int) -> list[Slice]:
    """Slices that have every decade once, of a table of ``size`` bytes with so many texts in each.

    The last one has all that is in no other, so no row is left out whatever decades come up.
    """
    share = size / max(1, sum(texts.values()))
    groups: list[list[int]] = [[]]
    filled = 0.0
    for decade in sorted(d for d in texts if d is not None):
        own = texts[decade] * share
        if groups[-1] and filled + own > most:
            groups.append([])
            filled = 0.0
        groups[-1].append(decade)
        filled += own
    named = [Slice(tuple(group), False) for group in groups[:-1]]
    return [*named, Slice(tuple(d for group in groups[:-1] for d in group))]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled goes from the disk when the write ends.

    Otherwise it stays until the driver happens to collect its garbage.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def in_turn(spark: SparkSession, folder: str, makers: list[Callable[[], DataFrame]]) -> DataFrame:
    """The rows of all makers, one made and stored in ``folder`` after the other."""
    paths = [f"{folder}/{number}" for number in range(len(makers))]
    with shuffles_dropped(spark):
        schemas = [staged(make(), path).schema for make, path in zip(makers, paths)]
    return spark.read.schema(schemas[0]).parquet(*paths)
