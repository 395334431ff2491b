import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest

from pairsift import stages
from pairsift.operators import stats
from pairsift.plans import job
from pairsift.plans.collocations import collocations, counted_pairs, counted_words, keep_in
from pairsift.operators.stats import bigram_outcomes, stage_funnel, unigram_outcomes
from pairsift.sources import corpus
from pairsift.sources.ngrams import parse_ngrams, read_sequence
from pairsift.sources.results import read_results, result_lines, write_results
from pairsift.sources.stopwords import stop_words
from pairsift.stages import SETTING

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def line_tables(spark, tmp_path_factory):
    """Unigram and bigram lines of the documents, in files."""
    texts = corpus.texts(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id")
    root = tmp_path_factory.mktemp("lines")
    corpus.unigram_lines(texts).write.text(f"{root}/unigrams")
    corpus.bigram_lines(texts).write.text(f"{root}/bigrams")
    return spark.read.text(f"{root}/unigrams"), spark.read.text(f"{root}/bigrams")


@pytest.fixture(scope="module")
def top(line_tables):
    return sorted(map(tuple, collocations(*line_tables).collect()))


def test_corpus_lines(spark):
    table = spark.createDataFrame(
        [(5, "a b  a\tb"), (17, " a "), (29, ""), (41, None), (3, "x")], "doc_id long, text string"
    )
    texts = corpus.texts(table, "doc_id")
    # The year of 5, 17, 29 and 41: 1950 + id % 7.
    assert sorted(r.value for r in corpus.unigram_lines(texts).collect()) == [
        "a\t1953\t1",
        "a\t1955\t2",
        "b\t1955\t2",
        "x\t1933\t1",
    ]
    assert sorted(r.value for r in corpus.bigram_lines(texts).collect()) == [
        "a b\t1955\t2",
        "b a\t1955\t1",
    ]


def test_result_is_well_formed(top):
    decades = defaultdict(list)
    for decade, rn, score, w1, w2 in top:
        decades[decade].append((rn, score, w1, w2))
    assert len(top) == 1200 and len(decades) == 12
    stop = set(stop_words())
    for rows in decades.values():
        assert [r[0] for r in rows] == list(range(1, 101))
        scores = [r[1] for r in rows]
        assert scores == sorted(scores, reverse=True) and min(scores) >= 0
        pairs = [r[2:] for r in rows]
        assert max(Counter(pairs).values()) == 1
        for word in (w for pair in pairs for w in pair):
            assert re.fullmatch("[a-z֐-׿]{2,}", word) and word not in stop


@pytest.mark.parametrize("partitions", ["1", "2", "7"])
def test_partitions_do_not_matter(line_tables, conf, top, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    assert sorted(map(tuple, collocations(*line_tables).collect())) == top


def test_stored_stages_do_not_matter(spark, line_tables, top, tmp_path):
    got = collocations(*line_tables, stage_dir=str(tmp_path))
    assert sorted(map(tuple, got.collect())) == top
    assert {p.name for p in tmp_path.iterdir()} == {"unigram_counts", "bigram_counts", "with_c1", "scored"}
    # A second run replaces the stages.
    got = collocations(line_tables[0], line_tables[1].limit(0), stage_dir=str(tmp_path))
    assert got.count() == 0


def test_funnel(spark, lines, tmp_path):
    bigrams = lines("big dog|1995|1", "big dog|1996|1", "the dog|1995|1", "big cat|1995|1", "x")
    unigrams = lines("big|1995|3", "Big|1995|3", "dog|1995|4", "7|1995|1")
    keep = keep_in(str(tmp_path))
    summed_pairs = keep("pairs", stats.summed_lines(stats.read_bigrams(bigrams, stop_words()), ["decade", "w1", "w2"]))
    summed_words = keep("words", stats.summed_lines(stats.read_unigrams(unigrams), ["decade", "w"]))
    pairs, words = stats.accepted_sums(summed_pairs, "c12"), stats.accepted_sums(summed_words, "c")
    assert sorted(pairs.collect()) == sorted(counted_pairs(bigrams).collect())
    assert sorted(words.collect()) == sorted(counted_words(unigrams).collect())
    assert sorted(stats.outcomes(summed_pairs).collect()) == sorted(bigram_outcomes(bigrams, stop_words()).collect())
    assert sorted(stats.outcomes(summed_words).collect()) == sorted(unigram_outcomes(unigrams).collect())
    got = stage_funnel(
        {"bigram": (stats.outcomes(summed_pairs), pairs), "unigram": (stats.outcomes(summed_words), words)},
        {"nothing": (pairs, pairs.limit(0))},
    )
    assert sorted(map(tuple, got.collect())) == [
        ("bigram_counts", 3, 2),
        ("bigram_lines", 5, 3),
        ("nothing", 2, 0),
        ("unigram_counts", 3, 2),
        ("unigram_lines", 4, 3),
    ]


def test_funnel_of_nothing(lines):
    none = lines()
    got = stage_funnel({"bigram": (bigram_outcomes(none, []), counted_pairs(none))}, {})
    assert sorted(map(tuple, got.collect())) == [("bigram_counts", 0, 0), ("bigram_lines", 0, 0)]


def test_result_lines_print_doubles_like_java(spark):
    ranked = spark.createDataFrame(
        [(1990, 1.1067861081433932e8, "a", "b"), (2000, 89.54586636290401, "תל", "אביב"),
         (2000, float("nan"), "c", "d")],
        "decade int, score double, w1 string, w2 string",
    )
    assert sorted(r.value for r in result_lines(ranked).collect()) == [
        "1990\t1.1067861081433932E8\ta,b",
        "2000\t89.54586636290401\tתל,אביב",
        "2000\tNaN\tc,d",
    ]


def test_sink(spark, line_tables, top, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "old").write_text("to be replaced")
    write_results(collocations(*line_tables), str(out), 3)
    files = list(out.glob("part-*"))
    assert 1 <= len(files) <= 3 and not (out / "old").exists()
    seen = []
    for file in files:
        rows = [line.split("\t") for line in file.read_text().splitlines()]
        keys = [(int(decade), -float(score)) for decade, score, _ in rows]
        assert keys == sorted(keys)
        seen.append({decade for decade, _ in keys})
    assert sum(map(len, seen)) == len(set.union(*seen)) == 12
    assert sum(len(f.read_text().splitlines()) for f in files) == len(top)


def test_sequence_files(spark, lines, tmp_path, plan_of):
    long_line = "x" * 5000
    table = lines("a b|1995|7", long_line, "שלום|2001|3|9", "", "x", *(f"w{i}|1990|{i}" for i in range(400)))
    corpus.write_sequence(table.repartition(3), str(tmp_path / "seq"))
    back = read_sequence(spark, str(tmp_path / "seq"))
    assert back.schema == table.schema
    assert sorted(back.collect()) == sorted(table.collect())
    assert parse_ngrams(back).count() == 402
    assert "Python" not in plan_of(back)


def line_files(line_tables, folder, file_format):
    paths = []
    for name, table in zip(("unigrams", "bigrams"), line_tables):
        paths.append(str(folder / name))
        if file_format == "text":
            table.write.text(paths[-1])
        else:
            corpus.write_sequence(table, paths[-1])
    return paths


def written(out):
    lines = sorted(line for f in out.glob("part-*") for line in f.read_text().splitlines())
    return [re.sub("\t.*\t", "\t", line) for line in lines]


def expected_lines(top):
    return sorted(f"{decade}\t{w1},{w2}" for decade, _, _, w1, w2 in top)


def test_job_with_four_arguments(line_tables, top, tmp_path):
    out = tmp_path / "out"
    job.main([*line_files(line_tables, tmp_path, "sequence"), str(out), "2"])
    assert sorted(written(out)) == expected_lines(top)
    # The stage tables nobody asked for are gone.
    assert {p.name for p in tmp_path.iterdir()} == {"unigrams", "bigrams", "out"}


def test_job_resumes(line_tables, top, tmp_path):
    paths, out, kept = line_files(line_tables, tmp_path, "text"), tmp_path / "out", tmp_path / "kept"
    job.main([*paths, str(out), "2", "1", "--format", "text", "--stage-dir", str(kept)])
    assert sorted(written(out)) == expected_lines(top)
    times = {p.name: p.stat().st_mtime_ns for p in kept.iterdir()}
    # As if the run had failed after the pair counts.
    for name in ("with_c1", "scored"):
        (kept / name / "_SUCCESS").unlink()
    job.main([*paths, str(out), "2", "--format", "text", "--stage-dir", str(kept), "--resume"])
    assert sorted(written(out)) == expected_lines(top)
    again = {p.name: p.stat().st_mtime_ns for p in kept.iterdir()}
    assert {name for name in times if times[name] != again[name]} == {"with_c1", "scored"}
    other = [paths[1], paths[0], str(out), "2", "--format", "text", "--stage-dir", str(kept), "--resume"]
    with pytest.raises(ValueError, match="other inputs"):
        job.main(other)
    job.main([*paths, str(out), "1", "-k", "3", "--format", "text", "--stage-dir", str(kept)])
    assert len(written(out)) == 36


def test_results_are_read_back(spark, line_tables, top, tmp_path):
    write_results(collocations(*line_tables), str(tmp_path / "out"), 3)
    back = read_results(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted((d, s, a, b) for d, _, s, a, b in top)


class FakeSession:
    """A session with a master, a setting and a folder of its context."""

    def __init__(self, master, named=None, set_before=None):
        values = {"spark.sql.warehouse.dir": "file:/warehouse"} | ({SETTING: named} if named else {})
        self.conf = values
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: set_before)


def test_shared_folder(monkeypatch):
    scheme = lambda spark, path: (SimpleNamespace(getUri=lambda: SimpleNamespace(getScheme=lambda: path.split(":")[0])), path)
    monkeypatch.setattr(stages, "file_system", scheme)
    assert stages.shared_folder(FakeSession("yarn", "hdfs://x")) == "hdfs://x"
    assert stages.shared_folder(FakeSession("yarn", None, "hdfs://y")) == "hdfs://y"
    with pytest.raises(ValueError, match=SETTING):
        stages.shared_folder(FakeSession("yarn"))
    with pytest.raises(ValueError, match="single machine"):
        stages.shared_folder(FakeSession("yarn", "file:/tmp/x"))
    assert stages.shared_folder(FakeSession("local[4]", "file:/tmp/x")) == "file:/tmp/x"
    assert stages.shared_folder(FakeSession("local[4]")) == "file:/warehouse/_stages"
