"""Ranked search against scores of all documents by definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pairsift.llm import lexical
from tests.llm.helpers import documents, got, odd_rows, with_clashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_definition(rows, items, k=50):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in rows]
    n_docs, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    result = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            score = 0
            for term in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 50 + (50 * c.total() * n_docs) // length
                score += w * ((1000000000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        result += [(item_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(result, key=repr)


def made(seed, n_docs, n_items):
    """Documents with a few very frequent words, copies and ties; items cut out of them."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    rows = [(i, " ".join(rnd.choices(words, weights, k=rnd.randint(1, 80)))) for i in range(n_docs)]
    rows += [(n_docs + i, rows[i % 7][1]) for i in range(n_docs // 3)]
    rnd.shuffle(rows)
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 25)))) for i in range(n_items)]
    return rows, items


@pytest.mark.parametrize("block_docs, chunk_items, k", [(4096, 256, 50), (40, 7, 50), (64, 3, 4)])
def test_against_all_scores(spark, block_docs, chunk_items, k):
    rows, items = made(1, 600, 40)
    docs = with_clashes(documents(spark, rows)).selectExpr("*", "'x' AS term", "0L AS block")
    queries = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS rank", "'y' AS item")
    result = lexical.search(docs, queries, k, block_docs, chunk_items)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(result) == by_definition(rows, items, k)


def test_odd_rows_and_items(spark):
    rows = odd_rows()
    items = [(1, "W1 w2; W3-w4"), (2, None), (3, ""), (None, "no id here"), (4, "Ä ÄÖ É 漢字 😀 one"), (1, "W1 w2; W3-w4"),
             (5, "never seen"), (6, "\x1c\xa0e f"), (7, " ".join(f"w{i}" for i in range(300)))]
    result = lexical.search(with_clashes(documents(spark, rows)), spark.createDataFrame(items, ITEMS), block_docs=20)
    assert got(result) == by_definition(rows, items)


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b")]), spark.createDataFrame([(1, "a")], ITEMS)
    assert lexical.search(docs.where("doc_id > 1"), items).collect() == []
    assert lexical.search(docs, items.where("item_id > 1")).collect() == []
    assert lexical.search(documents(spark, [(1, None), (2, "...")]), items).collect() == []


def test_terms_are_found_on_bytes():
    rnd = random.Random(2)
    for _ in range(500):
        text = "".join(chr(rnd.choice([rnd.randrange(128), rnd.randrange(128, 0x800), 0x1F600])) for _ in range(40))
        assert [t.decode() for t in lexical.terms_of(text)] == terms_of(text)


class Reads:
    """Counts the positions that a list is read at."""

    def __init__(self, one):
        self.one, self.deepest = one, 0

    def __getattr__(self, name):
        return getattr(self.one, name)

    @property
    def docs(self):
        return self

    def __len__(self):
        return len(self.one.docs)

    def __getitem__(self, cut):
        self.deepest = max(self.deepest, min(cut.stop, len(self.one.docs)))
        return self.one.docs[cut]


def test_reading_stops_early_and_strictly():
    """Three documents lead all lists by far; the rest of the lists is never read."""
    n = 20_000
    docs = np.tile(np.arange(n), 3)
    terms = np.repeat([0, 1, 2], n)
    impacts = np.tile(np.where(np.arange(n) < 60, 1000, 1), 3)
    block = lexical.Block(terms, docs, impacts, n)
    block.lists = {name: Reads(one) for name, one in block.lists.items()}
    top, scores = block.best([0, 1, 2], 50)
    assert top.tolist() == list(range(50)) and set(scores) == {3000}
    assert max(one.deepest for one in block.lists.values()) <= 256
    # All scores are equal: any unread document could win by its number, so all are read.
    level = lexical.Block(terms, docs[::-1].copy(), np.ones(3 * n, np.int64), n)
    assert level.best([0, 1, 2], 50)[0].tolist() == list(range(50))


def test_best_positions_reach_beyond_the_last_read():
    """Direct accesses mark positions that sorted access has not come to."""
    rnd = np.random.default_rng(3)
    for _ in range(60):
        n = int(rnd.integers(1, 400))
        parts = []
        for term in range(4):
            own = rnd.choice(n, int(rnd.integers(0, n + 1)), replace=False)
            parts.append((np.full(len(own), term), own, rnd.integers(0, 30, len(own))))
        terms, docs, impacts = (np.concatenate(x) for x in zip(*parts))
        wanted = np.zeros(n, np.int64)
        np.add.at(wanted, docs, impacts)
        order = [d for d in np.lexsort((np.arange(n), -wanted)) if wanted[d] > 0][:20]
        top, scores = lexical.Block(terms, docs, impacts, n).best([0, 1, 2, 3, 9], 20)
        assert top.tolist() == order and scores.tolist() == wanted[order].tolist()


def test_filter_lets_all_terms_of_items_through(spark):
    rows = [(i, f"t{i} ü{i}") for i in range(500)]
    bits = lexical.filter_of(spark.createDataFrame([(t,) for _, x in rows for t in lexical.terms_of(x)], "term binary"))
    assert all(bits[b >> 3] >> (b & 7) & 1 for _, x in rows for b in map(lexical.bit_of, lexical.terms_of(x)))
    assert len(bits) * 8 == lexical.FILTER_BITS
