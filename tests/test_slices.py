"""Decades in slices, one after the other: the same rows, and less on disk at once."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from pairsift import slices
from pairsift.slices import Slice, in_turn, slices_of

# One for each way in which the queries are put together of slices.
SLICED = [
    "result_files", "rank_per_decade", "llr_score", "topk_per_decade", "topk_by_bounds", "collocations_hebrew",
    "collocations_from_sequence",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of two decades; some have no id or no text."""
    words = ["alpha", "beta", "gamma", "delta", "Stone", "rivers", "x1y", "(moon)"]
    rows = [
        (12 * i + decade, " ".join(words[(i * (j + 3) + j * j + decade) % 8] for j in range(12)))
        for decade, number in ((0, 9), (9, 30))
        for i in range(number)
    ]
    rows += [(None, "alpha beta gamma"), (24, None), (36, "")]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_every_decade_is_in_one_slice(spark):
    assert slices_of({1900: 5}, 100, 10) == [slices.WHOLE]
    assert slices_of({}, 100, 10) == [slices.WHOLE]
    found = slices_of({None: 1, 1910: 5, 1900: 2, 1990: 90, 2000: 2}, 100, 10)
    assert found == [Slice((1900, 1910), False), Slice((1990,), False), Slice((1900, 1910, 1990))]
    years = [None, -5, 0, 1899, 1900, 1909, 1910, 1995, 2000, 2017]
    table = spark.createDataFrame([(year,) for year in years], "year int")
    parts = [[row.year for row in part.rows(table).collect()] for part in found]
    assert parts == [[1900, 1909, 1910], [1995], [None, -5, 0, 1899, 2000, 2017]]


@pytest.mark.parametrize("name", SLICED)
def test_slices_give_the_same_rows(spark, folder, monkeypatch, name):
    query = entry.queries()[name]
    whole = query(spark, folder)
    assert len(entry.Tables(spark, folder).parts) == 1
    monkeypatch.setattr(slices, "SLICE_BYTES", 1000)
    assert len(entry.Tables(spark, folder).parts) == 2
    before = spark.conf.get(slices.CLEANUP)
    sliced = query(spark, folder)
    assert spark.conf.get(slices.CLEANUP) == before
    assert sliced.dtypes == whole.dtypes
    assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.collect())) != []


def test_shuffles_of_a_slice_are_gone(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def on_disk() -> int:
        found = (Path(folder.getPath()).rglob("shuffle_*.data") for folder in disk.localDirs())
        return sum(path.stat().st_size for paths in found for path in paths)

    seen = []

    def made(part: int):
        seen.append(on_disk())
        return spark.range(part * 10_000, (part + 1) * 10_000, 1, 4).repartition(3, "id").groupBy("id").count()

    before = on_disk()
    rows = in_turn(spark, str(tmp_path / "rows"), [lambda part=part: made(part) for part in range(3)])
    assert rows.count() == 30_000
    assert all(size <= before for size in seen), (before, seen)
