"""A Merkle manifest of a table: one tree per source, and one over the sources' roots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.llm.common import kept
from pairsift.stages import discarded

WIDTH = 16  # children of a node
LEVELS = 3  # levels that are closed within one block
CHUNK = 64  # blocks of an emitted batch, at most

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(parts: Iterable[str]) -> str:
    """Lowercase hex SHA-256 of texts one after another."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- appending


@dataclass(slots=True)
class Node:
    """A subtree that is complete, and what has become known of the way up from it.

    ``left`` and ``right`` are the others of its run, ``up`` the node that the run
    made. A leaf's witness is what hangs on it and on the nodes above it, so a subtree
    holds each sibling once for all its leaves.
    """

    digest: str
    left: list[str] = field(default_factory=list)
    right: list[str] = field(default_factory=list)
    up: Node | None = None

    def steps(self) -> Iterator[tuple[list[str], list[str]]]:
        """The siblings on the left and on the right, level by level."""
        node = self
        while node.up is not None:
            yield node.left, node.right
            node = node.up


class Appender:
    """Takes digests one after another, from a position that is aligned, and keeps witnesses.

    Each level has one open run. A node that comes is a later sibling of those already
    in the run, so their witnesses are extended by it and it starts with them on its
    left. A full run closes into a node, which is appended one level up.
    """

    def __init__(self, levels: int):
        self.runs: list[list[Node]] = [[] for _ in range(levels)]
        self.root: Node | None = None

    def append(self, value: str) -> Node:
        node = Node(value)
        self._add(0, node)
        return node

    def _add(self, level: int, node: Node) -> None:
        if level == len(self.runs):
            self.root = node
            return
        run = self.runs[level]
        node.left = [sibling.digest for sibling in run]
        for sibling in run:
            sibling.right.append(node.digest)
        run.append(node)
        if len(run) == WIDTH:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        node = Node(digest(sibling.digest for sibling in run))
        for sibling in run:
            sibling.up = node
        self._add(level + 1, node)

    def finish(self) -> Node:
        """Closes what is still open; the node on top."""
        for level, run in enumerate(self.runs):
            if run:
                self._close(level)
        return self.root


def height(leaves: int) -> int:
    """Levels until one node remains of so many leaves."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // WIDTH)
        levels += 1
    return levels


def folded(value: str, steps: Iterable[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and the siblings on its way make."""
    for left, right in steps:
        value = digest([*left, value, *right])
    return value


# ---------------------------------------------------------------- leaves


def sized(value: Column) -> Column:
    """``bytes:value``, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.encode(F.concat(*map(sized, values)), "UTF-8"), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, found`` of every row; ``found`` is the leaf as it is met later.

    Every fifth row (by a checksum of its id) is met with its text in lower case.
    """
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    number = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    text = F.col("text").cast("string")
    lowered = F.when(number % 5 == 0, F.translate(text, A_TO_Z, A_TO_Z.lower())).otherwise(text)
    source = F.col("source").cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),  # null first, then by bytes
        "doc_id",
        leaf(*columns, text).alias("leaf"),
        leaf(*columns, lowered).alias("found"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the row's place in its ``tree``, and ``size``, the tree's rows; stored.

    Rows are sorted by ranges, so a large tree is cut in many parts; a place is the one
    in the part plus the sizes of the tree's parts before, which are few rows. Rows equal
    in all of ``order`` are told apart by where they were stored, so any number of them
    can be cut.
    """
    unordered = kept(rows.withColumn("stored", F.monotonically_increasing_id()), "unordered")
    cut = ["tree", *order, "stored"]
    ordered = unordered.repartitionByRange(*(F.asc_nulls_first(c) for c in cut))
    ordered = ordered.sortWithinPartitions(*(F.asc_nulls_first(c) for c in cut))
    ordered = kept(ordered.drop("stored").withColumn("row", F.monotonically_increasing_id()), "ordered")
    discarded(unordered)
    ordered = ordered.withColumn("part", F.shiftright("row", 33))
    parts = ordered.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    sizes = parts.groupBy("tree").agg(F.sum("rows").alias("size"))
    parts = parts.join(sizes, "tree").select("tree", "part", "first", "before", "size")
    found = ordered.join(parts, ["tree", "part"])
    found = found.withColumn("at", F.col("row") - F.col("first") + F.col("before"))
    found = kept(found.drop("row", "part", "first", "before"), "placed")
    discarded(ordered)
    return found


# ---------------------------------------------------------------- blocks

ROOT = "tree string, at long, size long, digest string"
SIDES = "array<struct<left: array<string>, right: array<string>>>"
STEPS = f"tree string, block long, steps {SIDES}"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def blocks(nodes: DataFrame, levels: int, *more: str) -> DataFrame:
    """``tree, block, size, nodes``: the aligned blocks of a level's nodes, in one row each.

    A block has at most ``WIDTH**levels`` nodes, so a row has a bounded size.
    """
    block = F.expr(f"at div {WIDTH**levels}").alias("block")
    rows = nodes.groupBy("tree", block, "size").agg(F.collect_list(F.struct("at", "digest", *more)).alias("nodes"))
    return rows.withColumn("nodes", F.array_sort("nodes"))


def appended(size: int, digests: Iterable[str], levels: int) -> tuple[list[Node], Node]:
    """The nodes of one block of a level with ``size`` nodes, and the block's root."""
    appender = Appender(min(levels, height(size)))
    nodes = [appender.append(value) for value in digests]
    return nodes, appender.finish()


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The blocks' roots, as the nodes of the next level: ``tree, at, size, digest``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for size, row in zip(batch.column(2), batch.column(3)):
                values = row.values.field("digest").to_pylist()
                roots.append(appended(size.as_py(), values, levels)[1].digest)
            sizes = [-(-size.as_py() // WIDTH**levels) for size in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(roots, pa.string())],
                ["tree", "at", "size", "digest"],
            )

    return blocks(nodes.select("tree", "at", "size", "digest"), levels).mapInArrow(compute, ROOT)


SIDES_ARROW = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))


def with_steps(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """``tree, block, steps``: for each node the siblings from it to the root.

    ``nodes`` are a level's nodes and ``above`` the steps (``tree, block, steps``) of the
    blocks that they make. The witnesses within a block are made by appending once more;
    they are extended by the block's own.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, size, row, upper in zip(*(batch.column(i) for i in range(4))):
                values = row.values
                made, _ = appended(size.as_py(), values.field("digest").to_pylist(), levels)
                upper = upper.as_py() or []
                places = values.field("at").to_pylist()
                for begin in range(0, len(made), CHUNK):
                    cut = slice(begin, begin + CHUNK)
                    steps = [[*({"left": a, "right": b} for a, b in node.steps()), *upper] for node in made[cut]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree.as_py()] * len(steps)), pa.array(places[cut], pa.int64()), pa.array(steps, SIDES_ARROW)],
                        ["tree", "block", "steps"],
                    )

    rows = blocks(nodes.select("tree", "at", "size", "digest"), levels).join(above, ["tree", "block"], "left")
    return rows.select("tree", "size", "nodes", "steps").mapInArrow(compute, STEPS)


def climbed(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The levels above ``leaves`` (``tree, at, size, digest``), each stored, to where every tree has one node.

    The number of rounds grows with the logarithm of the largest tree, to the base
    of a block; the roots of a level's blocks are further appends, one level up.
    """
    found, most = [leaves], leaves.agg(F.max("size")).first()[0] or 1
    while most > 1:
        found.append(kept(block_roots(found[-1], levels), "roots"))
        most = -(-most // WIDTH**levels)
    return found


def descended(climb: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The steps (``tree, block, steps``) of the nodes of the lowest level of a climb; stored.

    ``above`` are those of its highest level.
    """
    above = kept(above, "steps")
    for level in reversed(climb[:-1]):
        lower = kept(with_steps(level, above, levels), "steps")
        discarded(above)
        above = lower
    return above


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    A leaf is the SHA-256 of the row's ``doc_id, source, lang, n_chars, text``, each as
    bytes, colon, value, or ``-`` if null. The leaves of a source, in ascending order of
    ``doc_id`` (null first; rows of one id by their leaves), are hashed in runs of 16
    until one node remains, the source's root; the roots of the sources, in order of
    their names' bytes (null first), likewise. ``proof_sha256`` is the hash of a leaf's
    siblings from the leaf to the root, ``folded_root`` the root made of these and of the
    row as it is met later: rows with an id whose checksum 5 divides are met with A-Z in
    lower case, so ``verified`` is false for those that have such a letter. A null id is
    never one of these. Rows that repeat have leaves of their own. An empty table gives
    an empty result; other columns are not read, whatever their names.

    Leaves are appended in aligned blocks of ``16**levels`` (4096), which Spark spreads
    over tasks whatever the sources' sizes are: a source with a third of all rows is as
    many blocks. A block gives its root only; the roots are appended in blocks again. On
    the way back each block gets the siblings above it once, appends its leaves once more
    to have the witnesses below, extends them by these, and puts out hashes of them; no
    witness of a document is ever stored or shuffled. A lost executor costs the blocks it
    had.
    """
    rows = placed(leaves_of(docs), ["doc_id", "leaf"])
    climb = climbed(rows.withColumnRenamed("leaf", "digest"), levels)
    # Each source's root is a leaf of the tree over the sources.
    tops = climb[-1].where("at = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = placed(tops, ["name"])
    top_climb = climbed(tops, levels)
    root = top_climb[-1].select("tree", F.col("digest").alias("root"))  # one row
    way_up = root.select("tree", F.lit(0).cast("long").alias("block"), F.array().cast(SIDES).alias("steps"))
    way_up = descended(top_climb, way_up, levels)
    named = tops.join(way_up.withColumnRenamed("block", "at"), ["tree", "at"]).join(root, "tree")
    named = kept(named.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "steps"), "sources")
    above = descended(climb[1:], named.select("tree", F.lit(0).cast("long").alias("block"), "steps"), levels)
    for done in (*climb[1:], tops, *top_climb[1:], way_up):
        discarded(done)
    return closed(rows, above, named, levels)


def closed(rows: DataFrame, above: DataFrame, named: DataFrame, levels: int) -> DataFrame:
    """The result's rows, block by block, from the leaves and the steps of their blocks."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, row, upper, subroot, root in zip(*(batch.column(i) for i in range(5))):
                upper, subroot, root = [(s["left"], s["right"]) for s in upper.as_py()], subroot.as_py(), root.as_py()
                values = row.values
                made, _ = appended(size.as_py(), values.field("digest").to_pylist(), levels)
                tail = "".join("".join(left) + "".join(right) for left, right in upper)
                proofs, roots = [], []
                for node, found in zip(made, values.field("found").to_pylist()):
                    own = list(node.steps())
                    proofs.append(digest([*(d for left, right in own for d in (*left, *right)), tail]))
                    roots.append(folded(folded(found, own), upper))
                n = len(made)
                yield pa.RecordBatch.from_arrays(
                    [values.field("doc_id"), values.field("digest"), pa.array([subroot] * n), pa.array([root] * n),
                     pa.array(proofs), pa.array(roots), pa.array([r == root for r in roots])],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    leaves = rows.select("tree", "at", "size", F.col("leaf").alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), "found")
    parts = blocks(leaves, levels, "doc_id", "found").join(above, ["tree", "block"]).join(named.drop("steps"), "tree")
    return parts.select("size", "nodes", "steps", "subroot", "root").mapInArrow(compute, RESULT)
