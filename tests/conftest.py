import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", folder.as_uri())
        .config("spark.sql.warehouse.dir", (folder / "warehouse").as_uri())
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def lines(spark):
    """Makes a table of lines out of fields separated by ``|``."""

    def make(*rows):
        return spark.createDataFrame([(row.replace("|", "\t"),) for row in rows], "value string")

    return make


def executed_plan(df):
    """The plan as it was run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


@pytest.fixture
def plan_of():
    return executed_plan
