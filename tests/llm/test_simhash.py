import random

import numpy as np
import pytest
import xxhash

from pairsift.llm import graph, simhash
from pairsift.llm.graph import components
from tests.llm.helpers import documents, got, odd_rows, with_clashes, words_of


def by_definition(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words_of(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints, distance):
    """For each fingerprint the smallest id in its component, by comparing all pairs."""
    different = sorted(set(prints.values())) if isinstance(prints, dict) else sorted({f for _, f in prints})
    parent = list(range(len(different)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(different, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            parent[root(i)] = root(int(j))
    least = {}
    for doc_id, value in prints:
        key = root(different.index(value))
        if doc_id is not None:
            least[key] = min(least.get(key, doc_id), doc_id)
    return {value: least.get(root(i)) for i, value in enumerate(different)}


def expected(rows, distance=4, words=4):
    prints = [(doc_id, by_definition(text, words)) for doc_id, text in rows]
    least = smallest_reachable(prints, distance)
    return sorted(((d, f"{f:016x}", least[f]) for d, f in prints), key=repr)


def test_against_brute_force(spark):
    rows = odd_rows()
    result = simhash.near_duplicates(with_clashes(documents(spark, rows)))
    assert got(result) == expected(rows)
    assert result.columns == ["doc_id", "fingerprint", "component_id"]


@pytest.mark.parametrize("distance", [0, 3, 9, 14])
def test_search_misses_no_link(spark, distance):
    """Fingerprints around a few centres, with bits that go together."""
    rnd = random.Random(distance)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0]
    values = set()
    for _ in range(900):
        value = rnd.choice(centres)
        for _ in range(rnd.randint(0, 12)):
            value ^= 1 << rnd.randrange(64)
        if rnd.random() < 0.3:
            value |= 0xFFFF
        values.add(value)
    values |= {rnd.getrandbits(64) for _ in range(600)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    points = spark.createDataFrame([(v,) for v in signed], "f0 long")
    labels = dict(got(simhash.component_labels(points, distance)))
    ours, theirs = {}, {}
    least = smallest_reachable([(v, v) for v in sorted(values)], distance)
    for value, s in zip(sorted(values), signed):
        ours.setdefault(labels.get(s, s), set()).add(s)
        theirs.setdefault(least[value], set()).add(s)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_thresholds_share_out_all_units():
    rnd = np.random.default_rng(1)
    costs = [np.sort(rnd.random((50, 5)) * 10, axis=1) for _ in range(4)]
    chosen = simhash.allocate(costs, 6)
    assert (sum(chosen) == 6).all()
    total = sum(cost[np.arange(50), used] for cost, used in zip(costs, chosen))
    best = np.full(50, np.inf)
    for a in range(5):
        for b in range(5):
            for c in range(5):
                if 0 <= 6 - a - b - c < 5:
                    best = np.minimum(best, costs[0][:, a] + costs[1][:, b] + costs[2][:, c] + costs[3][:, 6 - a - b - c])
    assert np.allclose(total, best)


def test_correlated_bits_go_together():
    rnd = np.random.default_rng(2)
    bits = rnd.integers(0, 2, (4000, 64))
    bits[:, 40], bits[:, 63] = bits[:, 7], 1 - bits[:, 7]
    groups = simhash.grouped((bits.T @ bits).astype(float), 4000, 4)
    assert sorted(sum(groups, [])) == list(range(64))
    assert any({7, 40, 63} <= set(group) for group in groups)


def test_components_of_a_chain_and_a_star(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    chain = [(order[i], order[i + 1]) for i in range(59)]
    star = [(1000, 1001 + i) for i in range(50)]
    labels = dict(got(components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long"))))
    assert len({labels[i] for i in range(60)}) == 1
    assert len({labels[i] for i in range(1000, 1051)}) == 1
    assert labels[0] != labels[1000]


def test_survivors(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rnd.choices(words, k=200)) for _ in range(40)]
    rows = list(enumerate(texts))
    edited = [(100 + i, text.replace(text.split()[100], "edited", 1)) for i, text in enumerate(texts[:20])]
    rows += edited + [(400, None), (401, " "), (None, texts[30]), (None, "alone")]
    docs = with_clashes(documents(spark, rows))
    left = simhash.survivors(docs)
    assert left.columns == docs.columns
    ids = [row.doc_id for row in left.collect()]
    wanted = {least for _, _, least in expected(rows)}
    assert None in wanted and 401 not in wanted and len(wanted) < len(rows) - 4
    assert sorted(ids, key=repr) == sorted(wanted, key=repr)
    # Two components without any id: one row of each stays.
    docs = documents(spark, [(None, texts[0]), (None, texts[0] + " more"), (None, texts[1])])
    assert simhash.survivors(docs).count() == 2


def test_empty_table(spark):
    empty = documents(spark, [(1, "x")]).where("doc_id > 1")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.survivors(empty).collect() == []


def test_survivors_by_definition(spark):
    """One row of each component, by comparing all pairs of fingerprints."""
    rows = [(i, text) for i, text in odd_rows() if i is not None]
    by_value = {f: least for (_, f, least) in expected(rows)}
    wanted = sorted({least for least in by_value.values()})
    left = simhash.survivors(documents(spark, rows))
    assert sorted({row.doc_id for row in left.collect()}) == wanted


@pytest.mark.parametrize("order", ["ascending", "bit reversed"])
def test_long_chains_take_few_rounds(spark, monkeypatch, order):
    rounds = []

    def counting(df, name, kept=graph.kept):
        rounds.extend([name] if name == "steps" else [])
        return kept(df, name)

    monkeypatch.setattr(graph, "kept", counting)
    ids = list(range(64)) if order == "ascending" else [int(f"{i:06b}"[::-1], 2) for i in range(64)]
    labels = dict(got(components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long"))))
    assert len(labels) == 64 and len(set(labels.values())) == 1
    assert len(rounds) <= 12
