"""SimHash near-duplicates: search by a pigeonhole principle with unequal thresholds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsift.llm.common import any_of, kept, whole_text
from pairsift.llm.graph import components
from pairsift.stages import discarded

BITS = 64
SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at a time
PARTS = range(2, 9)  # numbers of partitions to choose from
PROBE_COST = 50.0  # what one probe costs, in comparisons of two fingerprints
CHUNK = 200_000  # rows of an emitted batch


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each word shingle; A-Z in lower case, single spaces between words."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(word) + 1 for word in found])
    joined, last = b" ".join(found), min(words, len(found)) - 1
    starts = (ends - [len(word) + 1 for word in found]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[last:] - 1).tolist())]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; signed as Spark's bigint."""
    votes = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), BLOCK):
        block = hashes[begin : begin + BLOCK]
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_hash, f0``: the fingerprint of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(body.as_py(), words)) for body in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "text_hash", "f0"]
            )

    body = whole_text(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text")
    )
    return rows.mapInArrow(compute, "doc_id long, text_hash long, f0 long")


# ------------------------------------------------------------------- the search


def bits_of(values: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, the lowest first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def gathered(bits: np.ndarray, chosen: list[int]) -> np.ndarray:
    """The number that the chosen bits make."""
    weights = np.left_shift(np.int64(1), np.arange(len(chosen), dtype=np.int64))
    return bits[:, chosen].astype(np.int64) @ weights


def summed(points: DataFrame, length: int, vector: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all points of vectors of a fixed length, summed by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, np.int64)
        for batch in batches:
            total += vector(batch.column(0).to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    parts = points.select("f0").mapInArrow(partial, "at long, n long")
    result = np.zeros(length)
    for row in parts.groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        result[row["at"]] = row["n"]
    return result


def grouped(together: np.ndarray, count: float, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of like size, correlated bits in one group.

    ``together[i, j]`` counts the points in which the bits i and j are both set.
    """
    share = np.diag(together) / max(count, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((together / max(count, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = set(range(BITS)), []
    for part in range(parts):
        size = BITS // parts + (part < BITS % parts)
        rest = sorted(left)
        group = [max(rest, key=lambda b: related[b, rest].sum())]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: related[b, group].sum()))
        left -= set(group)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[np.ndarray], units: int) -> list[np.ndarray]:
    """Units per partition and row at the least total cost, by dynamic programming.

    ``costs[i][:, u]`` is what ``u`` units cost in partition i; a partition with u
    units is searched up to the distance u - 1, and one without units not at all.
    """
    rows = len(costs[0])
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0.0
    choices = []
    for cost in costs:
        new = np.full_like(best, np.inf)
        choice = np.zeros(best.shape, np.int8)
        for used in range(min(units, cost.shape[1] - 1) + 1):
            total = best[:, : units + 1 - used] + cost[:, used : used + 1]
            better = total < new[:, used:]
            new[:, used:][better] = total[better]
            choice[:, used:][better] = used
        best = new
        choices.append(choice)
    left, found = np.full(rows, units), []
    for choice in reversed(choices):
        used = choice[np.arange(rows), left].astype(int)
        found.append(used)
        left = left - used
    return found[::-1]


@dataclass
class Plan:
    """How fingerprints are cut in partitions, and what a search in one may meet."""

    groups: list[list[int]]
    units: int  # distance + 1: shared out over the partitions
    reach: int  # most units of one partition
    # For each partition its blocks of at most eight bits, and for each block, value
    # and distance the share of points at that distance from the value.
    blocks: list[list[list[int]]]
    shares: list[list[np.ndarray]]
    rivals: float  # points that a point is compared with

    def values(self, bits: np.ndarray) -> list[np.ndarray]:
        return [gathered(bits, group) for group in self.groups]

    def costs(self, bits: np.ndarray) -> list[np.ndarray]:
        """For each partition and point, what 0, 1, ... units cost."""
        found = []
        for group, blocks, shares in zip(self.groups, self.blocks, self.shares):
            near = np.zeros((len(bits), self.reach))
            near[:, 0] = 1.0
            for block, share in zip(blocks, shares):
                own = share[gathered(bits, block)]
                both = np.zeros_like(near)
                for a in range(self.reach):
                    for b in range(min(self.reach - a, own.shape[1])):
                        both[:, a + b] += near[:, a] * own[:, b]
                near = both
            probes = [sum(comb(len(group), d) for d in range(u)) for u in range(self.reach + 1)]
            met = np.concatenate([np.zeros((len(bits), 1)), np.cumsum(near, axis=1)], axis=1)
            found.append(met * self.rivals + np.array(probes) * PROBE_COST)
        return found


def masks(width: int, units: int) -> np.ndarray:
    """All numbers of ``width`` bits with fewer than ``units`` bits set."""
    found = [0]
    for distance in range(1, units):
        found += [sum(1 << bit for bit in chosen) for chosen in combinations(range(width), distance)]
    return np.array(found, np.int64)


def planned(points: DataFrame, distance: int, rivals: float) -> Plan:
    """The plan with the least expected cost, from counts over all points."""

    def both_set(values: np.ndarray) -> np.ndarray:
        bits = bits_of(values).astype(np.float64)
        return np.append(bits.T @ bits, len(bits)).astype(np.int64)

    counts = summed(points, BITS * BITS + 1, both_set)
    together, count = counts[:-1].reshape(BITS, BITS), counts[-1]
    share = np.diag(together) / max(count, 1)
    differ = 2 * share * (1 - share)
    units = distance + 1
    reach = min(units, 4)

    def expected(groups: list[list[int]]) -> float:
        costs = []
        for group in groups:
            near = np.array([1.0] + [0.0] * (reach - 1))
            for bit in group:
                near = near * (1 - differ[bit]) + np.append(0, near[:-1]) * differ[bit]
            probes = np.array([sum(comb(len(group), d) for d in range(u)) for u in range(reach + 1)])
            costs.append((np.append(0, np.cumsum(near)) * rivals + probes * PROBE_COST)[None, :])
        chosen = allocate(costs, units)
        return sum(cost[0, used[0]] for cost, used in zip(costs, chosen))

    options = [grouped(together, count, parts) for parts in PARTS if parts * reach >= units]
    groups = min(options, key=expected)
    blocks = [[group[i : i + 8] for i in range(0, len(group), 8)] for group in groups]
    flat = [block for part in blocks for block in part]

    def values_counted(values: np.ndarray) -> np.ndarray:
        bits = bits_of(values)
        return np.concatenate([np.bincount(gathered(bits, b), minlength=256) for b in flat])

    seen = summed(points, 256 * len(flat), values_counted).reshape(-1, 256) / max(count, 1)
    apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
    shares = iter([np.stack([(apart == d) @ row for d in range(9)], axis=1) for row in seen])
    return Plan(groups, units, reach, blocks, [[next(shares) for _ in part] for part in blocks], rivals)


def key_of(part: int, values: np.ndarray) -> np.ndarray:
    return (np.int64(part) << 32) | values


def keyed(points: DataFrame, rows: Callable[..., Iterator[tuple[np.ndarray, ...]]]) -> DataFrame:
    """``key, f0, label, used``: the points under keys.

    ``rows`` gets the fingerprints of a batch and yields keys, the rows that they
    belong to, and for each row of the batch a number that goes along: for probes the
    units of its partitions, four bits each.
    """
    names = ["key", "f0", "label", "used"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f0, label = (column.to_numpy() for column in batch.columns)
            for key, own, used in rows(f0):
                for at in range(0, len(key), CHUNK):
                    cut = slice(at, at + CHUNK)
                    arrays = [key[cut], f0[own[cut]], label[own[cut]], used[own[cut]]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names)

    return points.select("f0", "label").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def index_rows(points: DataFrame, plan: Plan) -> DataFrame:
    """Every point under its value in each partition."""

    def rows(f0: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for part, values in enumerate(plan.values(bits_of(f0))):
            yield key_of(part, values), np.arange(len(f0)), np.zeros_like(f0)

    return keyed(points, rows)


def probe_rows(points: DataFrame, plan: Plan) -> DataFrame:
    """Every point under all values that its thresholds reach."""

    def rows(f0: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        bits = bits_of(f0)
        chosen = allocate(plan.costs(bits), plan.units)
        packed = sum(used.astype(np.int64) << (4 * part) for part, used in enumerate(chosen))
        for part, (values, used) in enumerate(zip(plan.values(bits), chosen)):
            for units in range(1, plan.reach + 1):
                at = np.flatnonzero(used == units)
                flips = masks(len(plan.groups[part]), units)
                step = max(1, CHUNK // len(flips))
                for begin in range(0, len(at), step):
                    own = at[begin : begin + step]
                    reached = (values[own][:, None] ^ flips[None, :]).ravel()
                    yield key_of(part, reached), np.repeat(own, len(flips)), packed

    return keyed(points, rows)


def apart(a: str, b: str) -> Column:
    """The number of bits in which two fingerprints differ."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def met_before(plan: Plan) -> Column:
    """Whether a probe ``a`` and a point ``b`` that meet under ``a_key`` do so in an
    earlier partition too: two points are returned once, not for each partition."""
    part = F.shiftright("a_key", 32).bitwiseAND(F.lit(15))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    found = []
    for number, group in enumerate(plan.groups[:-1]):
        mask = sum(1 << bit for bit in group)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        units = F.shiftright("a_used", 4 * number).bitwiseAND(F.lit(15))
        found.append((part > number) & (F.bit_count(differ.bitwiseAND(F.lit(signed))) < units))
    return any_of(found)


def component_labels(points: DataFrame, distance: int) -> DataFrame:
    """``node, label`` of all different fingerprints (``f0``) that are linked to others.

    Any two that differ in at most ``distance`` bits are found by the probes of either.
    A group of many like points would give all its pairs; so points are linked to the
    first one under each of their keys before, and the search returns only what links
    different groups.
    """
    plan = planned(points, distance, points.count())

    def side(rows: DataFrame, letter: str) -> DataFrame:
        return rows.select("key", F.col("f0").alias(letter), *(F.col(n).alias(f"{letter}_{n}") for n in ("label", "used")))

    alone = points.select("f0", F.col("f0").alias("label"))
    index = index_rows(alone, plan)
    first = index.groupBy("key").agg(F.min("f0").alias("a"))
    stars = side(index, "b").join(first, "key")
    stars = stars.where((F.col("a") != F.col("b")) & (apart("a", "b") <= distance))
    stars = kept(stars.select("a", "b").distinct(), "stars")

    joined = components(stars)
    grouped_points = points.select("f0").join(joined.withColumnRenamed("node", "f0"), "f0", "left")
    grouped_points = kept(grouped_points.withColumn("label", F.coalesce("label", "f0")), "grouped")
    discarded(joined)
    probes = side(probe_rows(grouped_points, plan), "a").withColumnRenamed("key", "a_key")
    found = side(index_rows(grouped_points, plan), "b")
    # A plain join, so that adaptive execution can split a key that many share.
    pairs = probes.join(
        found,
        (F.col("a_key") == F.col("key"))
        & (F.col("a") < F.col("b"))
        & (F.col("a_label") != F.col("b_label"))
        & (apart("a", "b") <= distance)
        & ~met_before(plan),
    )
    more = kept(pairs.select("a", "b").distinct(), "found")
    labels = components(stars.union(more))
    for done in (grouped_points, stars, more):
        discarded(done)
    return labels


# ------------------------------------------------------------------ near copies


def grouped_rows(docs: DataFrame, distance: int, words: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_hash, f0, component_id, stays`` of every row; see :func:`near_duplicates`.

    ``stays`` holds the row of its component that comes first: that of the smallest id,
    of rows without an id that of the smallest hash of the text.
    """
    rows = kept(fingerprints(docs, words, doc_id, text), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    points = kept(rows.groupBy("f0").agg(F.min(own).alias("first")), "points")
    labels = component_labels(points, distance).withColumnRenamed("node", "f0")
    labelled = points.join(labels, "f0", "left").withColumn("label", F.coalesce("label", "f0"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("stays"))
    found = labelled.join(smallest, "label")
    found = kept(found.select("f0", F.col("stays.doc_id").alias("component_id"), "stays"), "members")
    discarded(points)
    discarded(labels)
    # Many documents may share a fingerprint: a plain join over stored tables, which
    # adaptive execution splits.
    return rows.join(found, "f0").select("doc_id", "text_hash", "f0", "component_id", (own == F.col("stays")).alias("stays"))


def near_duplicates(
    docs: DataFrame, distance: int = 4, words: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    The fingerprint is the 64-bit SimHash of the text's word shingles, repeats
    included, A-Z in lower case; a text of fewer words has one shingle, the whole
    sequence, and one without words (a null one too) the fingerprint 0, linked like
    any other. Fingerprints that differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest id that links lead to, the row's own included.
    Rows without an id take part; a component of only such rows has a null id. Rows
    that repeat give rows that repeat; an empty table gives an empty result; other
    columns are not read.

    The search is exact: bits are cut in partitions, correlated bits in one, and each
    fingerprint distributes ``distance + 1`` units over the partitions at the least
    cost estimated for it. Any fingerprint within the distance then differs in fewer
    bits than the units of some partition, and is met under one of the values probed
    there.
    """
    rows = grouped_rows(docs, distance, words, doc_id, text)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(
    docs: DataFrame, distance: int = 4, words: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` from each component of :func:`near_duplicates`, all columns.

    The document with the smallest id stays; of a component without ids the one whose
    text has the smallest hash. Null and empty texts are one component (fingerprint 0).
    Rows that repeat an id and its text are one document and stay or go together. An
    empty table gives an empty result; columns of any other name are carried along.
    """
    found = grouped_rows(docs, distance, words, doc_id, text)
    left = found.where("stays").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = docs.select(
        F.col(doc_id).cast("long").alias("_id"),
        F.xxhash64(whole_text(text)).alias("_hash"),
        F.struct("*").alias("_row"),
    ).alias("d")
    same = F.col("d._id").eqNullSafe(F.col("g._id")) & (F.col("d._hash") == F.col("g._hash"))
    return rows.join(left.alias("g"), same, "left_semi").select("_row.*")
