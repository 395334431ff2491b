"""Weighted rendezvous hashing of records over shards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.llm.common import whole_text

DIGITS = 13  # hex digits of a hash; 52 bits are exact in a double


def score(key: Column, shard: int, weight: float) -> Column:
    """What a key bids for a shard; the lowest bid wins.

    Bids are exponential with rate ``weight``, so a shard wins a share of the keys
    in proportion to its weight. A bid depends on its own shard only: a new shard
    takes the keys that it wins, and no key moves between two old ones.
    """
    digest = F.md5(F.concat_ws("|", key, F.lit(str(shard))))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return -F.log((number + 0.5) / float(16**DIGITS)) / F.lit(float(weight))


def winner(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: the lowest bid, of equal bids the smaller shard."""
    bids = [
        F.struct(score(key, shard, weight).alias("bid"), F.lit(shard).alias("shard"))
        for shard, weight in weights.items()
        if weight > 0
    ]
    if not bids:
        raise ValueError("no shard has a weight above zero")
    best = F.least(*bids) if len(bids) > 1 else bids[0]
    return best["shard"]


def place(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    slot_buckets: int = 64,
    cut_bits: int = 4,
) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``weights`` maps shards to their weights; ``grown`` is the same after a change,
    for comparison (``grown_shard`` is null without it). Only the key decides, so
    rows with one key share a shard. A null key counts as the empty key. ``size``
    is the text's UTF-8 bytes plus 1, a null text having none. ``slot`` numbers a
    shard's rows from 0 without gaps, by hash bucket of the key, the first ``cut_bits``
    bits of the text's checksum, and then by key, checksum and size; rows equal in all
    three take their slots in any order. An empty table gives an empty result; other
    columns are not read.

    No task sees a whole shard: rows are numbered within the cuts of ``slot_buckets``
    buckets per shard and moved by the sizes of the cuts before. The rows of one key, the
    null key among them, are in one bucket but in all of its cuts, so a key with a third
    of the rows is many tasks. Give more of both for more rows (a cut is sorted by one
    task).
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    body = whole_text(text)
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        winner(name, weights).alias("shard"),
        (winner(name, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        (F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("int") % slot_buckets).alias("_bucket"),
    )
    rows = rows.withColumn("_cut", F.shiftright("text_crc32", 32 - cut_bits))
    bucket = ["shard", "_bucket", "_cut"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_bucket", "_cut").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per shard, bucket and cut, however many documents there are.
    starts = sizes.select(
        *bucket, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    in_bucket = Window.partitionBy(*bucket).orderBy(key, "text_crc32", "size")
    return (
        rows.withColumn("_place", F.row_number().over(in_bucket) - 1)
        .join(starts, bucket)
        .select(
            key, "size", "text_crc32", "law", "shard",
            (F.col("_start") + F.col("_place")).alias("slot"),
            "grown_shard",
        )
    )
