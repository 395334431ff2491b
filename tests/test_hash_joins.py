"""Queries look words up by hashing, as the command line does, unless the session says otherwise."""

import pytest

import __spark_entry__ as spark_entry
from pairsift.plans import job

LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


@pytest.fixture
def folder(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rows = [(i, f"big dog w{i % 40}ab red{'x' * (i % 3)} cat") for i in range(200)] + [(None, "a b"), (1, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_pairs_are_not_sorted_for_the_joins(spark, conf, folder, plan_of):
    conf(LIMIT, "0")
    spark.conf.unset(LIMIT)
    query = spark_entry.queries()["join_totals"]
    hashed = query(spark, folder)
    rows = sorted(map(tuple, hashed.collect()))
    assert rows and plan_of(hashed).count("ShuffledHashJoin") == 3
    conf(LIMIT, "0")  # the session's own setting stays
    merged = query(spark, folder)
    assert sorted(map(tuple, merged.collect())) == rows
    assert plan_of(merged).count("SortMergeJoin") == 3


def test_settings_of_the_session_stay(spark, conf):
    conf(LIMIT, "5MB")
    assert job.with_settings(spark).conf.get(LIMIT) == "5MB"
