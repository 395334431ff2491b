import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairsift.operators.scoring import with_score, with_terms

SCHEMA = "decade int, w1 string, w2 string, c1 bigint, c2 bigint, c12 bigint, n bigint"

# c1, c2, c12, n, score
KNOWN = [
    (100, 80, 40, 10000, 276.5351387468162),
    (100, 100, 1, 10000, 0.0),
    (50, 50, 50, 10000, 629.581318943315),
    (100, 80, 0, 10000, 1.6145532455888087),
    (0, 80, 5, 10000, 393.9203171468075),
    (100, 0, 5, 10000, 305.6847152799325),
    (0, 0, 5, 10000, 690.7835238725156),
    (3, 80, 5, 10000, 186.7280375936583),
    (100, 3, 5, 10000, 153.12152532028273),
    (10000, 80, 5, 10000, 6026.818359114575),
    (0, 80, 0, 10000, math.nan),
    (10000, 5, 5, 10000, math.nan),
]


def score_all(spark, counts):
    rows = [(i, "a", "b", *c) for i, c in enumerate(counts)]
    return [r.score for r in with_score(spark.createDataFrame(rows, SCHEMA)).orderBy("decade").collect()]


def by_entropy(c1, c2, c12, n):
    """G² of a proper 2x2 table by its textbook form, 2 Σ O ln(O/E)."""
    observed = [c12, c1 - c12, c2 - c12, n - c1 - c2 + c12]
    expected = [c1 * c2 / n, c1 * (n - c2) / n, (n - c1) * c2 / n, (n - c1) * (n - c2) / n]
    return 2 * sum(o * math.log(o / e) for o, e in zip(observed, expected) if o)


def test_known_scores(spark):
    for got, case in zip(score_all(spark, [c[:4] for c in KNOWN]), KNOWN):
        assert got == pytest.approx(case[4], rel=1e-12, abs=1e-9, nan_ok=True), case


def test_no_counts_at_all(spark):
    assert math.isnan(score_all(spark, [(0, 0, 0, 0)])[0])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.integers(1, 10**6)] * 4), min_size=50, max_size=200))
def test_proper_tables_match_the_textbook(spark, cells):
    tables = [(a + b, a + c, a, a + b + c + d) for a, b, c, d in cells]
    for got, table in zip(score_all(spark, tables), tables):
        assert got == pytest.approx(by_entropy(*table), rel=1e-6, abs=1e-4)
        assert got > -1e-4


def test_terms_add_up_to_the_score(spark):
    rows = [(i, "a", "b", *c[:4]) for i, c in enumerate(KNOWN[:10])]
    df = spark.createDataFrame(rows, SCHEMA)
    terms = with_terms(df).orderBy("decade").collect()
    scores = with_score(df).orderBy("decade").collect()
    for t, s in zip(terms, scores):
        total = 2 * ((t.dep_with + t.dep_without) - (t.ind_with + t.ind_without))
        assert total == pytest.approx(s.score)
