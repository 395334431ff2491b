"""Tables in key order over files, and sums kept from run to run."""

import time

import pytest
from pyspark.sql import functions as F

from pairsift.plans.collocations import counted_pairs
from pairsift.sources import ranges
from pairsift.sums import StoredSums

PAIRS = "decade int, w1 string, w2 string, c12 bigint"
KEY = ["decade", "w1", "w2"]


def pair_table(spark, n=30_000):
    """Pairs of several decades; a third begin with one word."""
    word = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    return spark.range(n).select(
        (F.lit(1900) + F.col("id") % 5 * 10).cast("int").alias("decade"),
        F.when(F.col("id") % 3 == 0, "mmm").otherwise(word).alias("w1"), F.concat(F.lit("x"), word).alias("w2"),
        F.col("id").alias("c12"),
    )


def files_read(df):
    """Files that the scan of a plan has opened."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.metrics().contains("numFiles"):
        node = node.children().apply(0)
    return node.metrics().apply("numFiles").value()


def test_files_hold_ranges_in_order(spark, tmp_path):
    pairs = pair_table(spark)
    ranges.write_ranges(pairs, str(tmp_path), 12)
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, pairs.collect()))
    bounds = sorted((tuple(r.least), tuple(r.most), r.rows) for r in spark.read.parquet(f"{tmp_path}/files").collect())
    assert 8 <= len(bounds) <= 12 and sum(n for *_, n in bounds) == 30_000
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert max(n for *_, n in bounds) < 3 * 30_000 / len(bounds)  # a frequent first word is cut as well


@pytest.mark.parametrize("word", ["bbc", "mmm", "a", "zzz", "", "jjjf"])
@pytest.mark.parametrize("decade", [None, 1920, 1890])
def test_look_ups(spark, tmp_path, word, decade):
    pairs = pair_table(spark, 6_000)
    ranges.write_ranges(pairs, str(tmp_path), 40)
    got = ranges.pairs_of(spark, str(tmp_path), [word], decade)
    wanted = pairs.where(F.col("w1") == word)
    wanted = wanted if decade is None else wanted.where(F.col("decade") == decade)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_look_ups_read_few_files(spark, tmp_path):
    ranges.write_ranges(pair_table(spark), str(tmp_path), 40)
    every = len(list((tmp_path / "rows").glob("part-*")))
    assert every > 30
    assert files_read(ranges.pairs_of(spark, str(tmp_path), ["bcd"], 1920)) == 1
    assert files_read(ranges.pairs_of(spark, str(tmp_path), ["bcd"])) <= 10  # one or two per decade
    assert files_read(ranges.pairs_of(spark, str(tmp_path), ["bcd", "bce"], 1930)) <= 2


def test_ranges_of_nothing(spark, tmp_path):
    ranges.write_ranges(pair_table(spark).where("decade = 0"), str(tmp_path), 4)
    assert ranges.pairs_of(spark, str(tmp_path), ["a"]).collect() == []


@pytest.fixture
def sums(spark, tmp_path):
    table = StoredSums(spark, f"{tmp_path}/sums", KEY, "c12")
    (tmp_path / "lines").mkdir()

    def write(name, *lines):
        path = tmp_path / "lines" / name
        path.write_text("".join(line.replace("|", "\t") + "\n" for line in lines))
        return str(path)

    def load(*paths):
        return table.load(paths, lambda names: counted_pairs(spark.read.text(names)), PAIRS)

    return table, write, load


def content(table):
    return sorted(map(tuple, table.rows(PAIRS).collect()))


def test_loads_add_up(spark, sums, tmp_path):
    table, write, load = sums
    a = write("a.txt", "big dog|1995|3", "big dog|1985|1", "big cat|1995|2")
    b = write("b.txt", "big dog|1996|4", "red dog|1996|1", "old cat|1885|9")
    assert content(table) == [] and load(a) == ["1980", "1990"]
    assert load(b) == ["1880", "1990"]
    both = sorted(map(tuple, counted_pairs(spark.read.text([a, b])).collect()))
    assert content(table) == both
    # 1980 lies where the first load has put it.
    assert table.decades() == {"1880": 2, "1980": 1, "1990": 2}
    table.cleaned()
    assert content(table) == both and not (tmp_path / "sums" / "sums" / "1" / "1990").exists()


def test_a_file_counts_once(sums):
    table, write, load = sums
    a = write("a.txt", "big dog|1995|3")
    load(a)
    assert load(a, a) == [] and content(table) == [(1990, "big", "dog", 3)]
    b = write("b.txt", "big dog|1995|5")
    load(a, b, b)
    assert content(table) == [(1990, "big", "dog", 8)]
    time.sleep(0.01)
    write("a.txt", "big dog|1995|100")
    with pytest.raises(ValueError, match="a.txt was changed"):
        load(a)


def test_a_load_that_dies_changes_nothing(spark, sums, tmp_path, monkeypatch):
    table, write, load = sums
    load(write("a.txt", "big dog|1995|3"))
    b = write("b.txt", "big dog|1995|5", "old cat|1885|9")
    with monkeypatch.context() as broken:
        broken.setattr("pairsift.sums.write_note", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(b)
    assert content(table) == [(1990, "big", "dog", 3)]
    (tmp_path / "sums" / "_load-2").write_text('{"deca')  # cut off
    (tmp_path / "sums" / "._load-2.crc").unlink(missing_ok=True)
    assert content(table) == [(1990, "big", "dog", 3)]
    (tmp_path / "sums" / "_load-2").unlink()
    load(b)
    assert content(table) == [(1880, "old", "cat", 9), (1990, "big", "dog", 8)]


def test_many_small_loads_equal_one(spark, sums):
    table, write, load = sums
    lines = [f"w{'abcdefg'[i % 7]} x{'abc'[i % 3]}|{1900 + i % 40}|{i}" for i in range(300)]
    paths = [write(f"{i}.txt", *lines[i::4]) for i in range(4)]
    for path in paths:
        load(path)
    assert content(table) == sorted(map(tuple, counted_pairs(spark.read.text(paths)).collect()))
    assert table.files().count() == 4
