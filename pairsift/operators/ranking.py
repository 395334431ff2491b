"""The strongest pairs of each decade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.stages import discarded, new_folder, staged

RANKED = ("decade", "rn", "score", "w1", "w2")

# Parts of a decade that are cut to k pairs each before they meet.
BUCKETS = 64


def best_first() -> list[Column]:
    """By score; equal scores by the words, so that ranks are the same each time.

    NaN ranks above all numbers.
    """
    return [F.desc("score"), F.asc("w1"), F.asc("w2")]


def topk_per_decade(scored: DataFrame, k: int = 100, buckets: int = BUCKETS) -> DataFrame:
    """``decade, rn, score, w1, w2`` of the ``k`` best pairs of each decade.

    Lazy for every ``k``. The pairs of a decade are dealt out to ``buckets`` parts by
    a hash and ranked there first, so one task gets a part of a decade and at most
    ``buckets * k`` pairs after that; more buckets for larger decades. Up to a ``k`` of
    its own Spark also cuts within each task before the first shuffle.
    """
    bucket = F.pmod(F.xxhash64("w1", "w2"), F.lit(buckets))
    in_part = F.row_number().over(Window.partitionBy("decade", bucket).orderBy(*best_first()))
    best = scored.select(*RANKED[:1], *RANKED[2:]).withColumn("rn", in_part).where(F.col("rn") <= k)
    rank = F.row_number().over(Window.partitionBy("decade").orderBy(*best_first()))
    best = best.withColumn("rn", rank).where(F.col("rn") <= k)
    return best.withColumn("rn", F.col("rn").cast("bigint")).select(*RANKED)


# Steps of a score's size in which pairs are counted: 32 for each factor of e.
STEPS = 32
ABOVE, BELOW = 1_000_000, -1_000_000  # of NaN and infinity, and of scores without a logarithm


def step_of(score: Column) -> Column:
    """A whole number that never falls when the score rises."""
    step = F.floor(F.log(score) * STEPS)
    above = F.isnan(score) | (score == float("inf"))
    return F.when(above, ABOVE).when(score > 0, step).otherwise(BELOW).cast("int")


def bounds_of(scored: DataFrame, k: int) -> DataFrame:
    """``decade, least``: the step that every one of a decade's ``k`` best pairs reaches.

    Pairs are counted by decade and step, in each task first, so a few thousand rows per
    decade are shuffled at most. Steps are taken from the top until they hold ``k`` pairs:
    a pair below has ``k`` better ones. A decade of fewer pairs keeps all.
    """
    counted = scored.groupBy("decade", step_of(F.col("score")).alias("step")).agg(F.count("*").alias("pairs"))
    down = Window.partitionBy("decade").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    better = F.coalesce(F.sum("pairs").over(down), F.lit(0))
    wanted = counted.withColumn("better", better).where(F.col("better") < k)
    return wanted.groupBy("decade").agg(F.min("step").alias("least"))


def may_be_best(scored: DataFrame, k: int) -> DataFrame:
    """The pairs that reach their decade's bound: all of the ``k`` best, and few others."""
    bounds = bounds_of(scored, k).withColumnRenamed("decade", "of")
    same = F.col("decade").eqNullSafe(F.col("of"))
    # One row per decade, which adaptive execution broadcasts; a decade's partition is
    # split otherwise, as nothing is grouped here.
    reached = scored.join(bounds, same).where(step_of(F.col("score")) >= F.col("least"))
    return reached.select(*scored.columns)


def topk_of_stored(scored: DataFrame, k: int = 100, buckets: int = BUCKETS) -> DataFrame:
    """:func:`topk_per_decade` of a stored table, which is read twice.

    The first pass finds a bound for each decade; pairs below it are dropped before any
    window sorts them. Of a table that is computed, not stored, this would compute all
    twice.
    """
    return topk_per_decade(may_be_best(scored, k), k, buckets)


def rank_per_decade(scored: DataFrame) -> DataFrame:
    """``decade, rn, score, w1, w2`` of all pairs, however many a decade has.

    Runs at once. A window over the decade would sort it in one task. Here all pairs
    are stored (finding ranges reads them once more, and should not compute them once
    more), sorted by ranges, which cuts a large decade in many parts, and stored with
    their place in the part. A pair's rank is that place plus the size of the
    decade's earlier parts, a small table stored beside.
    """
    spark = scored.sparkSession
    unordered = staged(scored.select("decade", "score", "w1", "w2"), new_folder(spark, "scored"))
    in_order = unordered.repartitionByRange("decade", *best_first()).sortWithinPartitions(
        "decade", *best_first()
    )
    # The id holds the part number above 33 bits of row number.
    numbered = in_order.withColumn("row", F.monotonically_increasing_id())
    ordered = staged(numbered, new_folder(spark, "ranked"))
    ordered = ordered.withColumn("part", F.shiftright("row", 33))
    discarded(unordered)

    parts = ordered.groupBy("decade", "part").agg(
        F.min("row").alias("first_row"), F.count("*").alias("size")
    )
    earlier = Window.partitionBy("decade").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    starts = parts.select("decade", "part", (before + 1 - F.col("first_row")).alias("shift"))
    starts = staged(starts, new_folder(spark, "starts"))
    return (
        ordered.join(starts, ["decade", "part"])
        .withColumn("rn", F.col("row") + F.col("shift"))
        .select(*RANKED)
    )
