"""Row counts taken in the jobs of a run."""

import pytest

from pairsift.operators.metrics import Metrics
from pairsift.plans import job
from pairsift.plans.collocations import collocations
from tests.test_pipeline import line_files, line_tables, top  # noqa: F401


def numbers(spark, metrics):
    return {row.stage: (row.rows_in, row.rows_out) for row in metrics.funnel(spark).collect()}


def test_numbers_are_those_of_the_tables(spark, line_tables, top, tmp_path):  # noqa: F811
    metrics = Metrics()
    got = collocations(*line_tables, stage_dir=str(tmp_path), metrics=metrics)
    assert sorted(map(tuple, got.collect())) == top
    metrics.taken()
    rows = {p.name: spark.read.parquet(str(p)).count() for p in tmp_path.iterdir()}
    found = numbers(spark, metrics)
    assert found["unigram_lines"][0] == line_tables[0].count()
    assert found["bigram_lines"][0] == line_tables[1].count()
    assert found["unigram_counts"][1] == found["totals"][0] == rows["unigram_counts"]
    assert found["bigram_counts"][1] == found["join_c1"][0] == rows["bigram_counts"]
    assert found["join_c1"][1] == found["join_c2"][0] == rows["with_c1"]
    assert found["score"][1] == found["top"][0] == rows["scored"]
    assert found["totals"][1] == 12 and found["top"][1] == len(top)


def test_counting_adds_no_job(spark, line_tables, tmp_path):  # noqa: F811
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, **options):
        spark.sparkContext.setJobGroup(name, name)
        try:
            collocations(*line_tables, stage_dir=str(tmp_path / name), **options).collect()
            return len(tracker.getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs("plain") == jobs("counted", metrics=Metrics())


def test_taken_over_stages_bring_their_numbers(spark, line_tables, tmp_path):  # noqa: F811
    files = line_files(line_tables, tmp_path, "text")
    folder = tmp_path / "stages"

    def run(**options):
        metrics = Metrics()
        lines = [spark.read.text(path) for path in files]
        collocations(*lines, stage_dir=str(folder), metrics=metrics, **options).collect()
        metrics.taken()
        return numbers(spark, metrics)

    first = run()
    assert None not in {n for pair in first.values() for n in pair}
    assert run(resume=True) == first
    (folder / "scored" / "_SUCCESS").unlink()
    assert run(resume=True) == first
    # A stage of a run that did not count has no numbers.
    (folder / "unigram_counts" / "_rows").unlink()
    got = run(resume=True)
    assert got["unigram_lines"] == (None, None) and got["bigram_lines"] == first["bigram_lines"]


def test_metrics_need_stages(spark, line_tables):  # noqa: F811
    with pytest.raises(ValueError, match="stage_dir"):
        collocations(*line_tables, metrics=Metrics())


def test_report_of_the_job(line_tables, tmp_path, capsys):  # noqa: F811
    files = line_files(line_tables, tmp_path, "text")
    job.main([*files, str(tmp_path / "out"), "2", "--format", "text", "--report"])
    printed = capsys.readouterr().out
    assert f"{line_tables[1].count()}" in printed and "join_c2" in printed
