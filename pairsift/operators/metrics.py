"""Rows counted on their way through a run, in the jobs that the run has anyway."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The funnel's stages, each with the counters of its rows in and out.
FUNNEL = {
    "unigram_lines": ("unigram_lines", "unigrams_accepted"),
    "unigram_counts": ("unigrams_accepted", "unigram_counts"),
    "bigram_lines": ("bigram_lines", "bigrams_accepted"),
    "bigram_counts": ("bigrams_accepted", "bigram_counts"),
    "join_c1": ("bigram_counts", "with_c1"),
    "join_c2": ("with_c1", "with_c2"),
    "totals": ("unigram_counts", "totals"),
    "score": ("with_c2", "scored"),
    "top": ("scored", "top"),
}


class Metrics:
    """Named row counts of one run.

    :meth:`counted` adds a counter to a table, which Spark sums up in the tasks that make
    the table's rows; nothing runs twice for it. A counter has its number when the job
    that it is part of has ended: :meth:`taken` waits for it, so ask only after that job.
    Spark adds up what tasks report, and tasks that are run again after an executor was
    lost report again: after such a loss numbers may be too large. ``stats.stage_funnel``
    counts stored tables, which is exact always.
    """

    def __init__(self) -> None:
        self.open: dict[str, Observation] = {}
        self.numbers: dict[str, int | None] = {}

    def counted(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with a counter of its rows."""
        self.open[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self.open[name], F.count(F.lit(1)).alias("rows"))

    def taken(self) -> dict[str, int]:
        """The numbers of all counters added since the last call, whose job has ended."""
        numbers = {name: observation.get["rows"] for name, observation in self.open.items()}
        self.open.clear()
        self.numbers |= numbers
        return numbers

    def given(self, names: list[str], numbers: dict[str, int] | None) -> None:
        """Numbers of an earlier run, for counters whose job does not run in this one."""
        for name in names:
            self.open.pop(name, None)
            self.numbers[name] = (numbers or {}).get(name)

    def funnel(self, spark: SparkSession) -> DataFrame:
        """``stage, rows_in, rows_out``; what was not counted is null."""
        rows = [(stage, *(self.numbers.get(name) for name in ends)) for stage, ends in FUNNEL.items()]
        return spark.createDataFrame(rows, "stage string, rows_in long, rows_out long")


class Uncounted(Metrics):
    """Counts nothing."""

    def counted(self, name: str, df: DataFrame) -> DataFrame:
        return df

    def given(self, names: list[str], numbers: dict[str, int] | None) -> None:
        pass
