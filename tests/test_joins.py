import pytest
from pyspark.sql import functions as F

from pairsift.operators.counts import decade_totals
from pairsift.operators.joins import with_totals, with_word_count
from pairsift.plans.collocations import counted_words, scored_pairs

PAIRS = "decade int, w1 string, w2 string, c12 bigint"


@pytest.fixture
def shuffle_joins(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def small_parts(conf):
    """Makes adaptive execution treat some kilobytes like gigabytes."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")


def test_unknown_words_count_zero(spark):
    pairs = spark.createDataFrame([(1990, "a", "b", 5), (1990, "x", "y", 6)], PAIRS)
    words = spark.createDataFrame(
        [(1990, "a", 7), (2000, "x", 8), (1990, "b", 9), (1990, "z", 1)],
        "decade int, w string, c bigint",
    )
    got = with_word_count(with_word_count(pairs, words, "w1", "c1"), words, "w2", "c2")
    assert got.columns == ["decade", "w1", "w2", "c12", "c1", "c2"]
    assert sorted(map(tuple, got.collect())) == [
        (1990, "a", "b", 5, 7, 9),
        (1990, "x", "y", 6, 0, 0),
    ]


def test_decade_without_words(spark):
    pairs = spark.createDataFrame([(1990, "a", "b", 5), (1980, "a", "b", 6)], PAIRS)
    totals = spark.createDataFrame([(1990, 70)], "decade int, n bigint")
    lenient = with_totals(pairs, totals, strict=False)
    assert {r.decade: r.n for r in lenient.collect()} == {1990: 70, 1980: None}
    with pytest.raises(Exception, match="no unigrams for decade 1980"):
        with_totals(pairs, totals).collect()
    assert with_totals(pairs.where("decade = 1990"), totals).collect()[0].n == 70


def hot_inputs(spark):
    """Pairs a third of which begin, and a third end, with one word; all in one
    decade but some. Words are counted from lines, as in a pipeline."""
    n = 60_000
    word = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    hot = F.lit("hot")
    pairs = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 50 == 0, 1980).otherwise(1990).alias("decade"),
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("p"), word)).alias("w1"),
        F.when(F.col("id") % 3 == 1, hot).otherwise(F.concat(F.lit("q"), word)).alias("w2"),
        (F.col("id") % 7 + 1).alias("c12"),
    )
    # Counted anew, so that the joins get the output of an aggregate.
    pairs = pairs.groupBy("decade", "w1", "w2").agg(F.sum("c12").alias("c12"))
    known = spark.range(0, n, 1, 4).where("id % 2 = 0").select(
        F.explode(F.array(hot, F.concat(F.lit("p"), word), F.concat(F.lit("q"), word))).alias("w"),
        F.when(F.col("id") % 50 == 0, 1985).otherwise(1995).alias("year"),
    )
    return pairs, known.select(F.concat_ws("\t", "w", "year", F.lit(3)).alias("value"))


def expected_counts(pairs, lines):
    counts, totals = {}, {}
    for line in lines.collect():
        w, year, cnt = line.value.split("\t")
        decade = int(year) // 10 * 10
        counts[decade, w] = counts.get((decade, w), 0) + int(cnt)
        totals[decade] = totals.get(decade, 0) + int(cnt)
    return sorted(
        (*p, counts.get((p.decade, p.w1), 0), counts.get((p.decade, p.w2), 0), totals[p.decade])
        for p in pairs.collect()
    )


def joined(pairs, lines):
    unigrams = counted_words(lines)
    got = with_word_count(pairs, unigrams, "w1", "c1")
    got = with_word_count(got, unigrams, "w2", "c2")
    return with_totals(got, decade_totals(unigrams))


@pytest.mark.parametrize(
    ("join", "hashed_up_to"), [("SortMergeJoin", "0"), ("ShuffledHashJoin", "64MB")]
)
def test_hot_words_and_decades_are_split(
    spark, plan_of, shuffle_joins, small_parts, conf, join, hashed_up_to
):
    conf("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", hashed_up_to)
    conf("spark.sql.shuffle.partitions", "20")
    # Small shuffles would be read by a single task, whose output cannot be split.
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pairs, lines = hot_inputs(spark)
    got = joined(pairs, lines)
    assert sorted(map(tuple, got.collect())) == expected_counts(pairs, lines)
    plan = plan_of(got)
    # Both words and the decade.
    assert plan.count(f"{join}(skew=true)") == 3


def test_small_tables_are_broadcast(spark, plan_of):
    pairs, lines = hot_inputs(spark)
    got = joined(pairs, lines)
    assert sorted(map(tuple, got.collect())) == expected_counts(pairs, lines)
    plan = plan_of(got)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_word_lines_are_read_once(spark, plan_of, shuffle_joins, tmp_path):
    """The counts for both words and for the totals come out of one shuffle."""
    pairs, lines = hot_inputs(spark)
    lines.write.text(str(tmp_path / "lines"))
    lines = spark.read.text(str(tmp_path / "lines"))
    plan = plan_of(scored_pairs(counted_words(lines), pairs))
    assert plan.count("FileScan text") == 1
    assert plan.count("ReusedExchange") == 2
