"""Every registered query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as spark_entry
from verify_oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", spark_entry.QUERIES)
def test_query(spark, name):
    result = compare(spark, FOLDER, name)
    assert result.startswith("ok"), result


def test_every_query_has_its_sql():
    assert set(spark_entry.oracle_sql()) >= set(spark_entry.QUERIES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 1200
