"""The whole computation against a plain loop over odd random lines."""

import math
import random
import re
from collections import Counter

import pytest

from pairsift.operators.stats import bigram_outcomes
from pairsift.plans.collocations import collocations
from pairsift.sources.stopwords import stop_words

BLANKS = "".join(map(chr, range(0x21)))
LETTERS = "a-z֐-׿"

WORDS = ["Dog", "cat", "_bird_", "of", "x", "'ve", "19th", "a1b", "תל", "של", "ארה״ב", "7", "CAT.", "\x01"]
GAPS = [" ", " ", " ", "  ", "\x0b", "\x01 ", " ", ""]
YEARS = ["1995", "1991", "2003", " 1995 ", "+1995", "-7", "199x", "1995.0", "", "2147483648", "1995\x7f"]
COUNTS = ["1", "5", "40", "0", "-2", " 3\x1f", "9.5", "", "x", "1e2", "99999999999999999999"]


def random_line(rng, size):
    words = [rng.choice(WORDS) for _ in range(rng.choice([size, size, size, size, 1, 2, 3, 0]))]
    gram = rng.choice(["", "", " ", "\x02"]) + rng.choice(GAPS).join(words) + rng.choice(["", "", " "])
    usual = rng.random() < 0.8
    fields = [
        gram,
        rng.choice(YEARS[:4]) if usual else rng.choice(YEARS),
        rng.choice(COUNTS[:3]) if usual else rng.choice(COUNTS),
        "7",
        "",
    ]
    return "\t".join(fields[: rng.choice([3, 3, 4, 4, 4, 5, 2, 1])])


def fields_of(line):
    fields = line.split("\t")
    while fields and not fields[-1]:
        fields.pop()
    return fields


def number(text, bits):
    text = text.strip(BLANKS)
    if re.fullmatch("[+-]?[0-9]+", text) and -(2 ** (bits - 1)) <= int(text) < 2 ** (bits - 1):
        return int(text)
    return None


def word(raw):
    runs = re.findall(f"[{LETTERS}]+", raw.lower())
    return runs[0] if len(runs) == 1 and len(runs[0]) > 1 else None


def decade(year):
    return math.trunc(year / 10) * 10


def pair_of(line, stop):
    """The outcome of a bigram line, and its row if accepted."""
    fields = fields_of(line)
    if len(fields) < 3:
        return "fields", None
    year, count = number(fields[1], 32), number(fields[2], 64)
    tokens = [t for t in re.split("[ \t\n\x0b\f\r]+", fields[0].strip(BLANKS))]
    if year is None:
        return "year", None
    if len(tokens) != 2:
        return "tokens", None
    w1, w2 = map(word, tokens)
    if w1 is None or w2 is None:
        return "word", None
    if w1 in stop or w2 in stop:
        return "stopword", None
    if count is None:
        return "count", None
    return "accepted", (decade(year), w1, w2, count)


def divide(a, b):
    if b:
        return a / b
    return math.nan if a == 0 else math.copysign(math.inf, a)


def surprise(hits, trials, chance):
    """How unlikely the hits are; chances of 0 and 1 count as almost so."""
    if not math.isnan(chance):
        chance = min(max(chance, 1e-15), 1 - 1e-15)
    return -hits * math.log(chance) - (trials - hits) * math.log(1 - chance)


def score(c1, c2, c12, n):
    gain = 0.0
    for hits, trials in ((c12, c1), (c2 - c12, n - c1)):
        gain += surprise(hits, trials, divide(c2, n)) - surprise(hits, trials, divide(hits, trials))
    return 2 * gain


def by_hand(unigram_lines, bigram_lines, stop):
    words, totals, pairs = Counter(), Counter(), Counter()
    for line in unigram_lines:
        fields = fields_of(line)
        if len(fields) < 3:
            continue
        year, count, w = number(fields[1], 32), number(fields[2], 64), word(fields[0])
        if None not in (year, count, w):
            words[decade(year), w] += count
            totals[decade(year)] += count
    for line in bigram_lines:
        _, row = pair_of(line, stop)
        if row:
            pairs[row[:3]] += row[3]
    return {
        (d, w1, w2): score(words[d, w1], words[d, w2], c12, totals[d])
        for (d, w1, w2), c12 in pairs.items()
    }


@pytest.mark.parametrize("seed", range(4))
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    unigrams = [random_line(rng, 1) for _ in range(1500)]
    # Every decade that pairs can have must have words.
    unigrams += [f"filler\t{year}\t{rng.randint(1, 9)}" for year in (1995, 2003, 3, -5)]
    bigrams = [random_line(rng, 2) for _ in range(3000)]
    stop = set(stop_words())

    def table(rows):
        return spark.createDataFrame([(r,) for r in rows], "value string")

    got = collocations(table(unigrams), table(bigrams), k=1000).collect()
    expected = by_hand(unigrams, bigrams, stop)
    assert len(expected) > 50
    assert {(r.decade, r.w1, r.w2) for r in got} == set(expected)
    for r in got:
        assert r.score == pytest.approx(
            expected[r.decade, r.w1, r.w2], rel=1e-9, abs=1e-6, nan_ok=True
        )
    for d in {r.decade for r in got}:
        rows = sorted((r for r in got if r.decade == d), key=lambda r: r.rn)
        assert [r.rn for r in rows] == list(range(1, len(rows) + 1))
        order = [(not math.isnan(r.score), 0 if math.isnan(r.score) else -r.score, r.w1, r.w2) for r in rows]
        assert order == sorted(order)

    outcomes = Counter(pair_of(line, stop)[0] for line in bigrams)
    assert dict(bigram_outcomes(table(bigrams), stop).collect()) == dict(outcomes)
