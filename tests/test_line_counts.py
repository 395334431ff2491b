"""Lines of pairs, which are summed where they meet and not in the tasks that read the texts."""

from collections import Counter

from pairsift.sources import corpus


def documents(spark):
    rows = [(i, "a b a b\n c\td  \x0bé" if i % 3 else " x y z z z ") for i in range(60)]
    return spark.createDataFrame([*rows, (None, "a b"), (7, None), (7, ""), (7, " \t"), (7, "one")], "doc_id long, text string")


def test_bigram_lines(spark):
    table = documents(spark)
    expected = Counter()
    for doc_id, text in table.collect():
        tokens = [t for t in (text or "").replace(" ", "\0").split() if t]
        year = () if doc_id is None else (str(1900 + doc_id % 12 * 10 + doc_id % 7),)
        for pair in zip(tokens, tokens[1:]):
            expected["\t".join((" ".join(pair).replace("\0", " "), *year))] += 1
    got = [row.value for row in corpus.bigram_lines(corpus.texts(table, "doc_id")).collect()]
    assert sorted(got) == sorted(f"{key}\t{count}" for key, count in expected.items())


def test_tasks_that_read_texts_hold_no_sums(spark, plan_of, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "texts"))
    texts = corpus.texts(spark.read.parquet(str(tmp_path / "texts")), "doc_id")
    plan = plan_of(corpus.bigram_lines(texts))
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" in plan and "HashAggregate" not in before
