"""A Bloom filter of words, built and asked with Spark's own bitmap functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BITS = 8 * 4096  # bits of one bitmap of Spark's
BITS = 1 << 23
HASHES = 3


def part_of(keys: list[Column], bits: int) -> Column:
    """The part of a filter that has all bits of a key."""
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(bits // PART_BITS))


def positions(keys: list[Column]) -> list[Column]:
    """The bits of a key in its part, from 0."""
    return [F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(PART_BITS)) for seed in range(1, HASHES + 1)]


def built(table: DataFrame, keys: list[Column], bits: int = BITS) -> DataFrame:
    """``part, bitmap``: a filter of the keys of all rows, in at most ``bits / PART_BITS`` rows.

    Tasks fill bitmaps of their own and only these are shuffled. Filters of two tables are
    merged by :func:`merged`.
    """
    if bits <= 0 or bits % PART_BITS:
        raise ValueError(f"bits are a multiple of {PART_BITS}")
    at = table.select(part_of(keys, bits).alias("part"), F.explode(F.array(*positions(keys))).alias("at"))
    return at.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def merged(*filters: DataFrame) -> DataFrame:
    """One filter of what several filters of the same size have."""
    rows = filters[0]
    for more in filters[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def may_be_in(table: DataFrame, filter_: DataFrame, keys: list[Column], bits: int = BITS) -> DataFrame:
    """The rows whose keys the filter may have; only keys that it has not are dropped.

    The filter is broadcast: it has ``bits`` bits, however many keys are in it.
    """
    found = F.lit(True)
    for at in positions(keys):
        byte = F.conv(F.hex(F.substring("bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at % 8 + 1).cast("int"))
        found = found & (byte.bitwiseAND(bit) != 0)
    rows = table.withColumn("part", part_of(keys, bits)).join(F.broadcast(filter_), "part")
    return rows.where(found).select(*table.columns)


def words_of_pairs(pairs: DataFrame, bits: int = BITS) -> DataFrame:
    """A filter of the words (with their decade) of all pairs, first and second ones."""
    ends = [built(pairs, [F.col("decade"), F.col(word)], bits) for word in ("w1", "w2")]
    return merged(*ends)


def words_in_pairs(unigrams: DataFrame, filter_: DataFrame, bits: int = BITS) -> DataFrame:
    """The word counts that some pair may ask for."""
    return may_be_in(unigrams, filter_, [F.col("decade"), F.col("w")], bits)


def any_of(conditions: list[Column]) -> Column:
    """Whether one of the conditions holds; of none, false."""
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found
