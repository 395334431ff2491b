"""Reports on a run: rows per stage, lines left out, pairs over time."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.functions.text import clean_token, computed, decade_of, token_list, whole_number
from pairsift.operators.cleaning import one_of
from pairsift.sources.ngrams import field, line_fields

ACCEPTED = "accepted"


def full_fields(lines: DataFrame) -> DataFrame:
    """The ``fields`` of lines; empty ones at the end of a line do not count."""
    return lines.select(line_fields(F.rtrim("value", F.lit("\t"))).alias("fields"))


def read_bigrams(lines: DataFrame, words: Iterable[str]) -> DataFrame:
    """``reason, decade, w1, w2, cnt`` of bigram lines.

    A line's reason is the first rule it breaks: ``fields``, ``year``, ``tokens``
    (not two), ``word`` (a token without a clean word), ``stopword``, ``count``; or
    ``accepted``.
    """
    words = [word.lower() for word in words]
    fields, tokens = F.col("fields"), F.col("tokens")
    read = full_fields(lines)
    read = computed(read, token_list(field(fields, 0)).alias("tokens"), kept=("fields",))
    read = computed(
        read,
        field(fields, 2).isNull().alias("short"),
        whole_number(field(fields, 1), "int").alias("year"),
        whole_number(field(fields, 2), "bigint").alias("cnt"),
        F.size(tokens).alias("tokens"),
        clean_token(F.get(tokens, F.lit(0))).alias("w1"),
        clean_token(F.get(tokens, F.lit(1))).alias("w2"),
    )
    reason = (
        F.when(F.col("short"), "fields")
        .when(F.col("year").isNull(), "year")
        .when(F.col("tokens") != 2, "tokens")
        .when(F.col("w1").isNull() | F.col("w2").isNull(), "word")
        .when(one_of("w1", words) | one_of("w2", words), "stopword")
        .when(F.col("cnt").isNull(), "count")
        .otherwise(ACCEPTED)
    )
    return read.select(reason.alias("reason"), decade_of(F.col("year")).alias("decade"), "w1", "w2", "cnt")


def read_unigrams(lines: DataFrame) -> DataFrame:
    """``reason, decade, w, cnt`` of unigram lines: ``fields``, ``word``, ``year``, ``count``."""
    fields = F.col("fields")
    read = computed(
        full_fields(lines),
        field(fields, 2).isNull().alias("short"),
        whole_number(field(fields, 1), "int").alias("year"),
        whole_number(field(fields, 2), "bigint").alias("cnt"),
        clean_token(field(fields, 0)).alias("w"),
    )
    reason = (
        F.when(F.col("short"), "fields")
        .when(F.col("w").isNull(), "word")
        .when(F.col("year").isNull(), "year")
        .when(F.col("cnt").isNull(), "count")
        .otherwise(ACCEPTED)
    )
    return read.select(reason.alias("reason"), decade_of(F.col("year")).alias("decade"), "w", "cnt")


def summed_lines(read: DataFrame, key: list[str]) -> DataFrame:
    """Lines and counts of lines read, by reason and, if accepted, by ``key``.

    One pass gives both what was counted (:func:`accepted_sums`) and what became of
    the lines (:func:`outcomes`).
    """
    accepted = F.col("reason") == ACCEPTED
    return read.groupBy("reason", *(F.when(accepted, F.col(k)).alias(k) for k in key)).agg(
        F.sum(F.when(accepted, F.col("cnt"))).alias("cnt"), F.count("*").alias("lines")
    )


def accepted_sums(summed: DataFrame, count: str) -> DataFrame:
    """The key columns and the sum, named ``count``, of the lines accepted."""
    kept = summed.where(F.col("reason") == ACCEPTED).withColumnRenamed("cnt", count)
    return kept.drop("reason", "lines")


def outcomes(summed: DataFrame) -> DataFrame:
    """``reason, cnt``: lines by what became of them."""
    return summed.groupBy("reason").agg(F.sum("lines").alias("cnt"))


def bigram_outcomes(lines: DataFrame, words: Iterable[str]) -> DataFrame:
    """``reason, cnt``: what became of bigram lines, see :func:`read_bigrams`."""
    return read_bigrams(lines, words).groupBy("reason").agg(F.count("*").alias("cnt"))


def unigram_outcomes(lines: DataFrame) -> DataFrame:
    """The same for unigram lines."""
    return read_unigrams(lines).groupBy("reason").agg(F.count("*").alias("cnt"))


def rejects_by_reason(counted: DataFrame) -> DataFrame:
    """``reason, cnt`` of the lines that were left out."""
    return counted.where(F.col("reason") != ACCEPTED)


def stage_funnel(
    sums: Mapping[str, tuple[DataFrame, DataFrame]], steps: Mapping[str, tuple[DataFrame, DataFrame]]
) -> DataFrame:
    """``stage, rows_in, rows_out``.

    ``sums`` maps a name to the outcomes of its lines and the table counted from
    them; it gives two stages, ``<name>_lines`` (lines read and accepted) and
    ``<name>_counts`` (accepted rows and sums). ``steps`` maps the other stages
    to the tables before and after. Tables are counted where they are: give
    stored ones (see ``stages.staged``), whose rows the file footers know.
    """
    none = F.lit(0).cast("bigint")

    def side(stage: str, df: DataFrame, rows_in: Column, rows_out: Column) -> DataFrame:
        counted = df.agg(rows_in.alias("rows_in"), rows_out.alias("rows_out"))
        return counted.select(F.lit(stage).alias("stage"), "rows_in", "rows_out")

    read = F.sum("cnt")
    accepted = F.sum(F.when(F.col("reason") == ACCEPTED, F.col("cnt")))
    sides = []
    for name, (became, counted) in sums.items():
        sides.append(side(f"{name}_lines", became, read, accepted))
        sides.append(side(f"{name}_counts", became, accepted, F.max(none)))
        sides.append(side(f"{name}_counts", counted, F.max(none), F.count("*")))
    for name, (before, after) in steps.items():
        sides.append(side(name, before, F.count("*"), F.max(none)))
        sides.append(side(name, after, F.max(none), F.count("*")))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), none).alias(name)

    rows = reduce(DataFrame.unionByName, sides)
    return rows.groupBy("stage").agg(total("rows_in"), total("rows_out"))


def pair_decades(ranked: DataFrame) -> DataFrame:
    """``w1, w2, decades``: the decades in whose list a pair stands.

    A pair's group has one row per decade.
    """
    decades = F.sort_array(F.collect_set("decade")).cast("array<string>")
    return ranked.groupBy("w1", "w2").agg(F.concat_ws(",", decades).alias("decades"))


def pair_runs(ranked: DataFrame, open_end: bool = True) -> DataFrame:
    """``w1, w2, first_decade, last_decade, decades, runs``: when a pair stood in the lists.

    ``runs`` lists runs of decades without a gap, in order: ``1790, 1860-1880, 1900+``. A
    run that reaches the last decade of all lists ends in ``+`` (unless not ``open_end``).
    Decades that repeat count once. Islands are found by the difference of a decade and
    its number in the pair's own order, in one shuffle by pair: a group has one row per
    decade. A pair without a decade is left out.
    """
    days = ranked.where("decade IS NOT NULL").select("w1", "w2", "decade").distinct()
    number = F.row_number().over(Window.partitionBy("w1", "w2").orderBy("decade"))
    islands = days.withColumn("island", F.col("decade") - 10 * number)
    runs = islands.groupBy("w1", "w2", "island").agg(
        F.min("decade").alias("first"), F.max("decade").alias("last"), F.count("*").alias("decades")
    )
    first, until = F.col("first").cast("string"), F.col("last").cast("string")
    at_the_end = F.col("last") == ranked.agg(F.max("decade")).scalar() if open_end else F.lit(False)
    text = F.when(at_the_end, F.concat(first, F.lit("+")))
    text = text.when(F.col("first") == F.col("last"), first).otherwise(F.concat(first, F.lit("-"), until))
    listed = F.sort_array(F.collect_list(F.struct("first", "text")))
    return runs.withColumn("text", text).groupBy("w1", "w2").agg(
        F.min("first").alias("first_decade"),
        F.max("last").alias("last_decade"),
        F.sum("decades").alias("decades"),
        F.concat_ws(", ", listed["text"]).alias("runs"),
    )
