import math

import pytest

from pairsift.operators.ranking import rank_per_decade, topk_per_decade
from pairsift.operators.stats import pair_decades

SCORED = "decade int, w1 string, w2 string, score double"


def many(spark, n=5000):
    """Three decades, the first with most rows; every score is shared by many."""
    return spark.createDataFrame(
        [
            (1990 if i % 10 else 2000 + i % 20, f"w{i * 7919 % n}", f"v{i}", float(i % 37))
            for i in range(n)
        ],
        SCORED,
    )


def by_hand(rows, k=None):
    out, place = [], {}
    for r in sorted(rows, key=lambda r: (r.decade, -r.score, r.w1, r.w2)):
        place[r.decade] = place.get(r.decade, 0) + 1
        if k is None or place[r.decade] <= k:
            out.append((r.decade, place[r.decade], r.score, r.w1, r.w2))
    return out


def test_top_k(spark, plan_of):
    df = many(spark)
    top = topk_per_decade(df, 100)
    assert sorted(map(tuple, top.collect())) == by_hand(df.collect(), 100)
    assert top.columns == ["decade", "rn", "score", "w1", "w2"]
    # Tasks drop what cannot be among the best before they shuffle.
    assert plan_of(top).count("WindowGroupLimit") == 4


@pytest.mark.parametrize("partitions", ["1", "2", "7", "40"])
def test_full_ranking(spark, conf, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = many(spark)
    ranked = rank_per_decade(df)
    assert sorted(map(tuple, ranked.collect())) == by_hand(df.collect())


def test_full_ranking_cuts_a_decade(spark, conf, plan_of):
    conf("spark.sql.shuffle.partitions", "10")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranked = rank_per_decade(many(spark))
    # The window is over the parts, which are stored, and not over the pairs.
    assert "Window" not in plan_of(ranked)
    (folder,) = {name.rsplit("/", 1)[0] for name in ranked.inputFiles() if "ranked-" in name}
    parts = spark.read.parquet(folder).selectExpr("decade", "row >> 33 AS part").distinct()
    assert parts.where("decade = 1990").count() > 3


def test_full_ranking_without_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = many(spark, 500)
    assert sorted(map(tuple, rank_per_decade(df).collect())) == by_hand(df.collect())


def test_full_ranking_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = many(spark)
    ranked = rank_per_decade(df.mapInPandas(counted, df.schema))
    assert ranked.count() == df.count() == seen.value


@pytest.mark.parametrize("k", [1, 100, 1000, 1001, 1500, 100_000])
def test_any_k(spark, k):
    df = many(spark)
    assert sorted(map(tuple, topk_per_decade(df, k, buckets=5).collect())) == by_hand(df.collect(), k)


def test_top_k_does_not_lean_on_a_threshold(spark, conf, plan_of):
    conf("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = many(spark)
    top = topk_per_decade(df, 100, buckets=8)
    assert sorted(map(tuple, top.collect())) == by_hand(df.collect(), 100)
    plan = plan_of(top)
    assert "WindowGroupLimit" not in plan
    # The parts of a decade are ranked apart before the decade is.
    assert plan.count("Window ") == 2 and plan.count("Exchange") == 2


@pytest.mark.parametrize("k", [100, 5000])
def test_building_the_plan_starts_no_job(spark, k):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        topk_per_decade(many(spark), k)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fewer_pairs_than_k_and_none_at_all(spark):
    df = many(spark, 50)
    assert topk_per_decade(df, 100).count() == 50
    assert topk_per_decade(df.limit(0), 100).count() == 0
    assert rank_per_decade(df.limit(0)).count() == 0


def test_nan_and_infinity_rank_first(spark):
    df = spark.createDataFrame(
        [(1990, "a", "b", 5.0), (1990, "c", "d", math.nan), (1990, "e", "f", math.inf)], SCORED
    )
    for ranked in (topk_per_decade(df), rank_per_decade(df)):
        assert [r.w1 for r in ranked.orderBy("rn").collect()] == ["c", "e", "a"]


def test_pair_decades(spark):
    ranked = spark.createDataFrame(
        [(2000, 1, 2.0, "a", "b"), (1990, 1, 3.0, "a", "b"), (1990, 2, 1.0, "c", "d")],
        "decade int, rn bigint, score double, w1 string, w2 string",
    )
    assert sorted(map(tuple, pair_decades(ranked).collect())) == [
        ("a", "b", "1990,2000"),
        ("c", "d", "1990"),
    ]
