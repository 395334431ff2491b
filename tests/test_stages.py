"""Stage tables: their buckets, and the manifests that say what they were made with."""

import re
import time

import pytest

from pairsift import manifests
from pairsift.plans import collocations as plan
from pairsift.plans import job
from pairsift.plans.collocations import collocations
from pairsift.stages import Buckets, staged, stored
from tests.test_pipeline import FOLDER, line_files, line_tables, top, written  # noqa: F401


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def files(line_tables, tmp_path):  # noqa: F811
    return line_files(line_tables, tmp_path, "text")


def run(spark, files, folder, **options):
    lines = [spark.read.text(path) for path in files]
    return collocations(*lines, stage_dir=str(folder), **options)


def times(folder):
    return {p.name: (p / "_SUCCESS").stat().st_mtime_ns for p in folder.iterdir()}


def remade(folder, before):
    after = times(folder)
    return {name for name in after if before.get(name) != after[name]}


def test_stage_in_buckets(spark, tmp_path):
    rows = [(i % 7, f"w{i % 11}", i) for i in range(500)] + [(None, None, 0)]
    df = spark.createDataFrame(rows, "decade int, w string, c bigint")
    layout = Buckets(("decade", "w"), 5)
    for _ in range(2):  # the second time replaces the first
        back = staged(df, f"{tmp_path}/stage", layout)
        assert back.schema == df.schema and sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert len(list((tmp_path / "stage").glob("part-*"))) <= 5
    assert stored(spark, f"{tmp_path}/stage", df, layout).count() == 501
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stage_")]


def test_joins_shuffle_nothing(spark, files, tmp_path, no_broadcast, plan_of):
    folder = tmp_path / "stages"
    run(spark, files, folder, buckets=4).collect()
    lines = [spark.read.text(path) for path in files]
    keep = plan.keep_in(str(folder), resume=True, buckets=4)
    words_of = plan.recipe(lines=manifests.input_of(lines[0]))
    listed = manifests.words_digest(plan.stop_words())
    pairs_of = plan.recipe(lines=manifests.input_of(lines[1]), stopwords=listed)
    before = times(folder)
    unigrams = plan.counted_words(lines[0], keep, words_of)
    pairs = plan.counted_pairs(lines[1], None, keep, pairs_of)
    assert remade(folder, before) == set()
    joined = plan.with_word_count(pairs, unigrams, "w1", "c1", in_place=True)
    executed = plan_of(joined)
    assert "SortMergeJoin" in executed and "Exchange" not in executed
    with_c1 = stored(spark, f"{folder}/with_c1", joined, Buckets(("decade", "w2"), 4))
    executed = plan_of(plan.with_word_count(with_c1, unigrams, "w2", "c2", in_place=True))
    assert "SortMergeJoin" in executed and "Exchange" not in executed


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_buckets_do_not_matter(spark, files, top, tmp_path, buckets):  # noqa: F811
    got = run(spark, files, tmp_path / "stages", buckets=buckets)
    assert sorted(map(tuple, got.collect())) == top
    before = times(tmp_path / "stages")
    again = run(spark, files, tmp_path / "stages", buckets=buckets, resume=True)
    assert sorted(map(tuple, again.collect())) == top
    assert remade(tmp_path / "stages", before) == set()


def test_resume_compares_what_stages_were_made_with(spark, files, top, tmp_path):  # noqa: F811
    folder = tmp_path / "stages"
    every = {"unigram_counts", "bigram_counts", "with_c1", "scored"}
    pairs_on = every - {"unigram_counts"}

    def resumed(**options):
        before = times(folder)
        rows = sorted(map(tuple, run(spark, files, folder, resume=True, **options).collect()))
        return rows, remade(folder, before)

    run(spark, files, folder)
    assert resumed() == (top, set())
    assert resumed(k=100, decimals=None) == (top, set())
    # Other stop words: pairs and what is made of them.
    some = sorted({row[3] for row in top} | {row[4] for row in top})[:20]
    rows, made = resumed(stopwords=some)
    assert made == pairs_on and not {w for row in rows for w in row[3:]} & set(some)
    assert rows == sorted(map(tuple, collocations(*map(spark.read.text, files), stopwords=some).collect()))
    # The same words as a table, in another order and case.
    table = spark.createDataFrame([(w.upper(),) for w in reversed(some)], "w string")
    rows_of_table, made = resumed(stopwords=table)
    assert rows_of_table == rows
    assert resumed(stopwords=table) == (rows, set())
    # A change of ``strict`` comes after the joins.
    assert resumed(stopwords=table, strict=False) == (rows, {"scored"})
    # Another layout of the same rows, which the scores do not depend on.
    assert resumed(stopwords=table, strict=False, buckets=2) == (rows, every - {"scored"})


def test_changed_files_are_read_again(spark, files, tmp_path):
    folder = tmp_path / "stages"
    before = run(spark, files, folder).count()
    time.sleep(0.01)
    with open(f"{files[1]}/part-more.txt", "w") as more:
        more.write("zzz yyy\t1995\t100000\n")
    stamps = times(folder)
    rows = [tuple(r)[3:] for r in run(spark, files, folder, resume=True).collect()]
    assert ("zzz", "yyy") in rows and len(rows) == before
    assert remade(folder, stamps) == {"bigram_counts", "with_c1", "scored"}
    # The same path with other lines of the same size.
    with open(f"{files[0]}/part-more.txt", "w") as more:
        more.write("zzz\t1995\t7\n")
    stamps = times(folder)
    run(spark, files, folder, resume=True)
    assert remade(folder, stamps) == {"unigram_counts", "with_c1", "scored"}


def test_other_steps_from_the_same_files_are_another_input(spark, files, tmp_path):
    folder = tmp_path / "stages"
    run(spark, files, folder)
    lines = [spark.read.text(path) for path in files]
    got = collocations(lines[0], lines[1].limit(0), stage_dir=str(folder), resume=True)
    assert got.count() == 0


def test_lines_in_memory_are_never_taken_for_known(spark, lines, tmp_path):
    def rows(count):
        got = collocations(
            lines("big|1995|9", "dog|1995|9"), lines(f"big dog|1995|{count}"), stage_dir=str(tmp_path), resume=True
        )
        return got.collect()

    assert rows(1) != rows(5)


def test_changed_code_makes_stages_again(spark, files, tmp_path, monkeypatch):
    folder = tmp_path / "stages"
    run(spark, files, folder)
    monkeypatch.setattr(plan, "CODE", plan.CODE[:-1])
    before = times(folder)
    run(spark, files, folder, resume=True)
    assert remade(folder, before) == {"unigram_counts", "bigram_counts", "with_c1", "scored"}


def test_a_broken_stage_is_made_again(spark, files, top, tmp_path):  # noqa: F811
    folder = tmp_path / "stages"
    run(spark, files, folder)
    (folder / "with_c1" / "_SUCCESS").unlink()
    (folder / "unigram_counts" / "_manifest").unlink()
    got = run(spark, files, folder, resume=True)
    assert sorted(map(tuple, got.collect())) == top
    assert manifests.read_note(spark, f"{folder}/unigram_counts") is not None


def test_job_with_sequence_files_stop_words_and_buckets(spark, line_tables, tmp_path):  # noqa: F811
    paths, out, kept = line_files(line_tables, tmp_path, "sequence"), tmp_path / "out", tmp_path / "kept"
    options = [*paths, str(out), "2", "--stage-dir", str(kept), "--buckets", "3"]
    job.main(options)
    first, before = written(out), times(kept)
    job.main([*options, "--resume"])
    assert written(out) == first and remade(kept, before) <= {"inputs"}
    word = re.split("[\t,]", first[0])[1]
    (tmp_path / "stop.txt").write_text(f"\n {word.upper()} \n")
    before = times(kept)
    job.main([*options, "--resume", "--stopwords", str(tmp_path / "stop.txt")])
    assert word not in {w for line in written(out) for w in re.split("[\t,]", line)[1:]}
    assert remade(kept, before) - {"inputs"} == {"bigram_counts", "with_c1", "scored"}
