"""The whole computation: from n-gram lines to the strongest pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsift import manifests
from pairsift.functions import likelihood, text
from pairsift.manifests import Recipe
from pairsift.operators import cleaning, counts, filters, joins, scoring
from pairsift.operators.cleaning import (
    clean_bigrams,
    clean_unigrams,
    without_stopword_rows,
    without_stopwords,
)
from pairsift.operators.counts import bigram_counts, decade_totals, unigram_counts
from pairsift.operators.joins import with_totals, with_word_count
from pairsift.operators.metrics import Metrics, Uncounted
from pairsift.operators.ranking import topk_of_stored, topk_per_decade
from pairsift.operators.scoring import with_score
from pairsift.sources import ngrams
from pairsift.sources.ngrams import parse_ngrams, split_bigrams
from pairsift.sources.stopwords import stop_words
from pairsift.stages import Buckets, complete, staged, stored

Keep = Callable[..., DataFrame]
UNCOUNTED = Uncounted()
CODE = (text, likelihood, ngrams, cleaning, counts, joins, scoring)  # what stages are made by


def recipe(**parts: object) -> Recipe | None:
    """What a stage is made with; None if it cannot be told of some part."""
    if any(part is None for part in parts.values()):
        return None
    return {"code": manifests.code_of(CODE), **parts}


def keep_in(
    folder: str | None, resume: bool = False, buckets: int | None = None, metrics: Metrics = UNCOUNTED
) -> Keep:
    """Stores a stage in ``folder``; without a folder, leaves it lazy.

    With ``resume`` a stage that is complete there and was made with the same recipe, by
    the manifest beside it, is read and not computed again. A stage without a recipe is
    always computed. With ``buckets`` a stage that names columns is laid out in so many
    buckets of them, so that the join on these columns finds its rows in place. Counters
    of ``metrics`` that a stage's job has are noted beside it, and taken from there if the
    stage is not computed again.
    """

    def keep(name: str, df: DataFrame, made_of: Recipe | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
        spark, path = df.sparkSession, f"{folder}/{name}"
        layout = Buckets(columns, buckets) if buckets and columns else None
        if made_of is not None:
            made_of = made_of | {"buckets": [*columns, buckets] if layout else []}
        if resume and made_of is not None and complete(spark, path):
            if manifests.read_note(spark, path) == made_of:
                metrics.given(list(metrics.open), manifests.read_note(spark, path, manifests.ROWS))
                return stored(spark, path, df, layout)
        rows = staged(df, path, layout)
        if numbers := metrics.taken():
            manifests.write_note(spark, path, numbers, manifests.ROWS)
        if made_of is not None:
            manifests.write_note(spark, path, made_of)
        return rows

    return keep if folder is not None else lambda name, df, made_of=None, columns=(): df


def counted_words(
    unigram_lines: DataFrame,
    keep: Keep = keep_in(None),
    made_of: Recipe | None = None,
    metrics: Metrics = UNCOUNTED,
) -> DataFrame:
    """``decade, w, c`` from unigram lines."""
    words = clean_unigrams(parse_ngrams(metrics.counted("unigram_lines", unigram_lines)))
    counted = unigram_counts(metrics.counted("unigrams_accepted", words))
    return keep("unigram_counts", metrics.counted("unigram_counts", counted), made_of, ("decade", "w"))


def counted_pairs(
    bigram_lines: DataFrame,
    stopwords: Iterable[str] | DataFrame | None = None,
    keep: Keep = keep_in(None),
    made_of: Recipe | None = None,
    metrics: Metrics = UNCOUNTED,
) -> DataFrame:
    """``decade, w1, w2, c12`` from bigram lines.

    A list of stop words is a test on each line; a table of them is held against the
    sums, which are fewer.
    """
    pairs = clean_bigrams(split_bigrams(parse_ngrams(metrics.counted("bigram_lines", bigram_lines))))
    if isinstance(stopwords, DataFrame):
        counted = without_stopword_rows(bigram_counts(metrics.counted("bigrams_accepted", pairs)), stopwords)
    else:
        words = stop_words() if stopwords is None else stopwords
        counted = bigram_counts(metrics.counted("bigrams_accepted", without_stopwords(pairs, words)))
    return keep("bigram_counts", metrics.counted("bigram_counts", counted), made_of, ("decade", "w1"))


def joined_pairs(unigrams: DataFrame, pairs: DataFrame, strict: bool = True) -> DataFrame:
    """``decade, w1, w2, c12, c1, c2, n`` from counted words and pairs."""
    joined = with_word_count(pairs, unigrams, "w1", "c1")
    joined = with_word_count(joined, unigrams, "w2", "c2")
    return with_totals(joined, decade_totals(unigrams), strict)


def scored_pairs(unigrams: DataFrame, pairs: DataFrame, strict: bool = True) -> DataFrame:
    """``decade, w1, w2, score`` from counted words and pairs."""
    return with_score(joined_pairs(unigrams, pairs, strict))


def collocations(
    unigram_lines: DataFrame,
    bigram_lines: DataFrame,
    k: int = 100,
    stopwords: Iterable[str] | DataFrame | None = None,
    strict: bool = True,
    stage_dir: str | None = None,
    resume: bool = False,
    decimals: int | None = None,
    buckets: int | None = None,
    paths: tuple[Iterable[str], Iterable[str]] | None = None,
    metrics: Metrics = UNCOUNTED,
    word_filter: int | None = None,
) -> DataFrame:
    """``decade, rn, score, w1, w2``: the ``k`` strongest pairs of each decade.

    ``stopwords`` replaces the built-in lists by words or by a table ``w``.
    With ``stage_dir`` the counted words and pairs, the pairs with the first word's
    count and the scored pairs are stored there as Parquet, so that later steps and
    retries start from them and not from the lines; without it the result is lazy.
    ``decimals`` rounds scores before they are ranked, so that two engines that differ in
    the last digits agree on the ranks.

    ``resume`` takes over the stages that an earlier run has completed there, if its
    manifests say that they were made with the same input files (paths, sizes, times of
    change) and steps, stop words, ``strict`` and code, and computes again the others and
    what comes after them. Lines that are not read from files alone have no such identity
    and are computed again, unless ``paths`` names the files of unigrams and bigrams.

    ``buckets`` lays the stages out in so many buckets of the columns that the next join
    uses. The joins then shuffle nothing, in this run or a resumed one, and pairs travel
    once per stage, when it is written. A word's pairs are in one bucket, though, which
    is not split if the word is very frequent; without buckets it is.

    ``metrics`` counts the rows of all steps in the jobs that store the stages, the last
    ones in the job that uses the result: call ``metrics.taken()`` after it. Counting
    needs ``stage_dir``, as a lazy run has some steps in its plan more than once. With a
    table of stop words lines with these count as accepted, as they go after the sums.

    ``word_filter`` is the size in bits of a filter of the pairs' words. Word counts that
    no pair asks for, which are most of them in texts with many rare words, then go
    before they are shuffled to the joins; decade totals have all words. The filter is
    built from the stored pairs, so it needs ``stage_dir``; a filter that is too small
    lets more words through and changes no result.
    """
    if word_filter and stage_dir is None:
        raise ValueError("a filter of words is built from stored pairs: name a stage_dir")
    if stage_dir is None and not isinstance(metrics, Uncounted):
        raise ValueError("metrics are counted while stages are stored: name a stage_dir")
    keep = keep_in(stage_dir, resume, buckets, metrics)
    in_place = buckets is not None and stage_dir is not None
    words_of = pairs_of = joined_of = scored_of = None
    if stage_dir is not None:
        words_paths, pairs_paths = paths or (None, None)
        listed = stop_words() if stopwords is None else stopwords
        words_of = recipe(lines=manifests.input_of(unigram_lines, words_paths))
        pairs_of = recipe(lines=manifests.input_of(bigram_lines, pairs_paths), stopwords=manifests.words_digest(listed))
        if words_of and pairs_of:
            joined_of = recipe(words=manifests.digest(words_of), pairs=manifests.digest(pairs_of))
            scored_of = recipe(joined=manifests.digest(joined_of), strict=strict)
    unigrams = counted_words(unigram_lines, keep, words_of, metrics)
    pairs = counted_pairs(bigram_lines, stopwords, keep, pairs_of, metrics)
    asked = unigrams
    if word_filter:
        filter_of = pairs_of and recipe(pairs=manifests.digest(pairs_of), bits=word_filter)
        words = keep("word_filter", filters.words_of_pairs(pairs, word_filter), filter_of)
        asked = filters.words_in_pairs(unigrams, words, word_filter)
    with_c1 = with_word_count(pairs, asked, "w1", "c1", in_place)
    with_c1 = keep("with_c1", metrics.counted("with_c1", with_c1), joined_of, ("decade", "w2"))
    with_c2 = metrics.counted("with_c2", with_word_count(with_c1, asked, "w2", "c2", in_place))
    totals = metrics.counted("totals", decade_totals(unigrams))
    scored = metrics.counted("scored", with_score(with_totals(with_c2, totals, strict)))
    scored = keep("scored", scored, scored_of)
    if decimals is not None:
        scored = scored.withColumn("score", F.round("score", decimals))
    best = topk_per_decade if stage_dir is None else topk_of_stored
    return metrics.counted("top", best(scored, k))
