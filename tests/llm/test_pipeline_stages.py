import hashlib
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import tiktoken

from pairsift.llm import byte_bpe, language, queries
from pairsift.llm.common import kept
from tests.llm.helpers import documents, odd_rows, with_clashes, words_of
from tests.llm.test_language import plain_prediction
from tests.llm.test_simhash import expected


def test_stages_on_odd_rows(spark):
    rows = [(i, t, "en" if n % 2 else "de") for n, (i, t) in enumerate(odd_rows())]
    docs = with_clashes(documents(spark, rows))
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = kept(stage(spark, before, "unused"), name)
        if name != "byte_bpe":
            assert after.columns == docs.columns
            extra = set(map(str, after.collect())) - set(map(str, before.collect()))
            assert not extra
        assert after.count() <= before.count()
        before = after
    assert before.count() > 0


def raked(cells, sweeps=12, share=0.5):
    """Wanted tokens by (source, lang, topic): each marginal scaled to its target in turn."""
    powers, everything = (0.5, 0.7, 0.8), sum(cells.values()) * share

    def sums(values, at):
        found = Counter()
        for cell, value in values.items():
            found[cell[at]] += value
        return found

    goals = []
    for at, power in enumerate(powers):
        target = {name: tokens**power for name, tokens in sums(cells, at).items()}
        goals.append({name: value / sum(target.values()) * everything for name, value in target.items()})
    wanted = {cell: tokens * share for cell, tokens in cells.items()}
    for _ in range(sweeps):
        for at in range(3):
            now = sums(wanted, at)
            wanted = {c: min(float(cells[c]), w * (goals[at][c[at]] / now[c[at]])) for c, w in wanted.items()}
    return wanted


def topic_of(text):
    for name, pattern in (
        ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|[0-9]{3}-[0-9]{4}|[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        ("legal", r"[Ll]icensed under|License,|[Cc]opyright"), ("table", r" \| "), ("list", r"\n.*\n.*\n"),
    ):
        if re.search(pattern, text):
            return name
    return "prose"


def test_decisions_by_plain_code(spark):
    """What each stage keeps of a whole table with odd rows in it, by loops over the rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [(10_000 + n, text) for n, (_, text) in enumerate(odd_rows())]
    docs = with_clashes(kept(docs.unionByName(documents(spark, odd)), "whole"))
    model = language.learn(docs)
    left = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def ids(name):
        nonlocal docs
        docs = kept(stages[name](spark, docs, "unused"), name)
        found = [r.doc_id for r in docs.collect()]
        assert len(found) == len(set(found))
        return set(found)

    guesses = {i: plain_prediction(model, r.text) for i, r in left.items()}
    left = {i: r for i, r in left.items() if guesses[i][0] != "und" and round(guesses[i][1], 6) >= 0.3}
    assert ids("language_id") == set(left)

    last = {}
    for i, r in left.items():
        last[r.text] = max(i, last.get(r.text, i))
    left = {i: left[i] for i in last.values()}
    assert ids("exact_dedup") == set(left)

    groups = {}
    for i, fingerprint, component in expected([(i, r.text) for i, r in left.items()]):
        groups.setdefault(component, []).append(i)
    assert all(min(group) == component for component, group in groups.items())
    left = {i: left[i] for i in groups}
    assert ids("simhash") == set(left)

    cells = Counter()
    cell_of = {i: (r.source or "?", r.lang or "?", topic_of(r.text)) for i, r in left.items()}
    for i, r in left.items():
        cells[cell_of[i]] += max(1, len(words_of(r.text)))
    wanted = raked(cells)
    draw = lambda i: int(hashlib.md5(f"1|{i}".encode()).hexdigest()[:13], 16) / 16**13
    left = {i: r for i, r in left.items() if draw(i) < wanted[cell_of[i]] / cells[cell_of[i]]}
    assert ids("mixing") == set(left)


def test_run_equals_the_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, folder), "stage")
    by_stages = {tuple(r) for r in docs.collect()}
    found = corpus_pipeline.run(spark, folder).collect()
    assert {tuple(r) for r in found} == by_stages
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_table(spark):
    docs = documents(spark, [(1, "x")]).where("doc_id > 1")
    for _, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, "unused"), "empty")
    assert docs.count() == 0


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "mixing", "byte_bpe"]
