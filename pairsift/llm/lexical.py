"""Ranked lexical search by the Best Position Algorithm over blocks of documents."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.llm.common import kept, whole_text
from pairsift.operators.filters import PART_BITS
from pairsift.stages import discarded

K = 50
BLOCK_DOCS = 4096  # documents of a block, about
CHUNK_ITEMS = 256  # items that meet a block at a time
FILTER_BITS = 1 << 20  # of the filter of the items' terms, whatever their number
FIRST_STEP = 32  # positions read of each list in the first round; twice as many in each next
EMITTED = 100_000  # rows of an emitted batch

# Letters and digits stay, A-Z in lower case; every byte of a character beyond ASCII stays.
KEPT_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return text.encode().translate(KEPT_BYTES).split()


def bit_of(term: bytes) -> int:
    return zlib.crc32(term) % FILTER_BITS


# ---------------------------------------------------------------- one block


@dataclass
class ImpactList:
    """A term's documents in a block, by impact and by number."""

    docs: np.ndarray  # by falling impact; equal impacts by number
    impacts: np.ndarray
    by_doc: np.ndarray  # the same documents by number
    doc_impacts: np.ndarray
    positions: np.ndarray  # where each of them stands by impact


class Block:
    """The impact lists of a block of documents."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        """Postings ``(term, doc, impact)``; documents are numbered from 0 in the order of ties."""
        by_impact = np.lexsort((docs, -impacts, terms))
        by_doc = np.lexsort((docs, terms))
        place = np.empty(len(terms), np.int64)
        place[by_impact] = np.arange(len(terms))
        names, starts = np.unique(terms[by_doc], return_index=True)
        self.n_docs = n_docs
        self.lists: dict[int, ImpactList] = {}
        for name, start, end in zip(names.tolist(), starts, [*starts[1:], len(terms)]):
            a, b = by_impact[start:end], by_doc[start:end]
            self.lists[name] = ImpactList(docs[a], impacts[a], docs[b], impacts[b], place[b] - start)

    def best(self, terms: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` documents of the highest score above 0 and their scores, in rank order.

        Lists are read from their tops side by side. A document that comes up is looked
        up in all lists at once (direct access), which gives its whole score and marks
        its position in each. The best position of a list is the last one up to which
        every position is marked, by either kind of access; no document that has not
        come up stands above it. So the sum of the impacts there bounds the scores of
        all documents still unseen, and reading ends when it is strictly below the
        ``k``-th score: one that equals it could still win by its number.
        """
        lists = [self.lists[term] for term in terms if term in self.lists]
        score = np.zeros(self.n_docs, np.int64)
        found = np.zeros(self.n_docs, bool)
        marked = [np.zeros(len(one.docs) + 1, bool) for one in lists]  # the last stays unmarked
        best = [0] * len(lists)  # the first position that is not marked
        depth, step = 0, FIRST_STEP
        while True:
            come = np.zeros(self.n_docs, bool)
            for one in lists:
                come[one.docs[depth : depth + step]] = True
            new = np.flatnonzero(come & ~found)
            found[new] = True
            for one, marks in zip(lists, marked):
                at = np.searchsorted(one.by_doc, new)
                at[at == len(one.by_doc)] = 0
                hit = one.by_doc[at] == new
                score[new[hit]] += one.doc_impacts[at[hit]]
                marks[one.positions[at[hit]]] = True
            bound = 0
            for i, (one, marks) in enumerate(zip(lists, marked)):
                best[i] += int(np.argmin(marks[best[i] :]))
                # A list seen to its end gives nothing to a document that is not in it.
                bound += int(one.impacts[best[i] - 1]) if best[i] < len(one.docs) else 0
            seen = np.flatnonzero(found & (score > 0))
            if bound == 0:
                break
            if len(seen) >= k and bound < np.partition(score[seen], len(seen) - k)[len(seen) - k]:
                break
            depth, step = depth + step, 2 * step
        top = seen[np.lexsort((seen, -score[seen]))[:k]]
        return top, score[top]


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What occurrences add to scores; whole numbers, rounded down."""
    m = 50 + (50 * n * n_docs) // max(length, 1)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def ranked(postings: pa.Table, items: pa.Table, k: int, n_docs: int, length: int) -> Iterator[tuple]:
    """For each item of ``items``: its number, rows of ``postings`` with its documents, and their scores."""
    weights = {}
    for terms in items["terms"].to_pylist():
        weights.update((term["term"], term["w"]) for term in terms)
    numbers = {term: i for i, term in enumerate(weights)}
    encoded = postings["term"].combine_chunks().dictionary_encode()
    number_of = np.array([numbers.get(term, -1) for term in encoded.dictionary.to_pylist()], np.int64)
    terms = number_of[encoded.indices.to_numpy()]
    wanted = np.flatnonzero(terms >= 0)
    if not len(wanted):
        return
    terms, postings = terms[wanted], postings.take(pa.array(wanted))
    rows, first, local = np.unique(postings["row"].to_numpy(), return_index=True, return_inverse=True)
    ids = postings["doc_id"].take(pa.array(first)).to_pylist()
    # Numbers in the order of ties: by id, rows without one last.
    order = sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i]))
    number = np.empty(len(rows), np.int64)
    number[order] = np.arange(len(rows))
    w = np.array(list(weights.values()), np.int64)[terms]
    added = impacts(postings["tf"].to_numpy(), postings["n"].to_numpy(), w, n_docs, length)
    block = Block(terms, number[local], added, len(rows))
    first = wanted[first[order]]
    for item, own in zip(items["for_item"].to_pylist(), items["terms"].to_pylist()):
        top, scores = block.best([numbers[term["term"]] for term in own], k)
        yield item, first[top], scores


# ---------------------------------------------------------------- the whole table


def filter_of(terms: DataFrame) -> bytes:
    """A map of FILTER_BITS bits, one or more of which every term sets; no larger for more terms."""
    bit = F.crc32("term") % FILTER_BITS
    part = F.floor(bit / PART_BITS).cast("int").alias("part")
    maps = terms.groupBy(part).agg(F.bitmap_construct_agg(bit % PART_BITS).alias("bits"))
    bits = bytearray(FILTER_BITS // 8)
    for row in maps.collect():  # at most FILTER_BITS / PART_BITS rows
        begin = row["part"] * PART_BITS // 8
        bits[begin : begin + PART_BITS // 8] = row["bits"]
    return bytes(bits)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, item_id, terms`` of every row of ``items``: its different terms."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(body.as_py()))) for body in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], ["item", "item_id", "terms"]
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("long").alias("item_id"), whole_text(text)
    )
    return rows.mapInArrow(compute, "item long, item_id long, terms array<binary>")


def counted(docs: DataFrame, wanted: bytes, doc_id: str, text: str) -> DataFrame:
    """``row, doc_id, term, tf, n``: the occurrences of terms that pass a filter, in every document.

    ``n`` counts all terms of the document. For each batch there is one more row without
    a term: ``tf`` documents with any term have ``n`` terms.
    """
    names = ["row", "doc_id", "term", "tf", "n"]
    bits = docs.sparkSession.sparkContext.broadcast(wanted)  # FILTER_BITS, not more

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = bits.value
        known: dict[bytes, bool] = {}

        def emitted(rows: list, total: tuple[int, int]) -> pa.RecordBatch:
            columns = zip(*[*rows, (None, None, None, *total)])
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            rows, with_terms, length = [], 0, 0
            for row, number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = terms_of(body.as_py())
                n = len(found)
                with_terms, length = with_terms + (n > 0), length + n
                for term, tf in Counter(found).items():
                    passed = known.get(term)
                    if passed is None:
                        if len(known) >= EMITTED:
                            known.clear()
                        bit = bit_of(term)
                        passed = known[term] = bool(passes[bit >> 3] >> (bit & 7) & 1)
                    if passed:
                        rows.append((row, number, term, tf, n))
                if len(rows) >= EMITTED:
                    yield emitted(rows, (with_terms, length))
                    rows, with_terms, length = [], 0, 0
            yield emitted(rows, (with_terms, length))

    rows = docs.select(F.monotonically_increasing_id(), F.col(doc_id).cast("long"), whole_text(text))
    return rows.mapInArrow(compute, "row long, doc_id long, term binary, tf long, n long")


def every(name: str, number: int) -> Column:
    """A row for each of so many numbers."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias(name)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    block_docs: int = BLOCK_DOCS,
    chunk_items: int = CHUNK_ITEMS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its ``k`` best documents.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
    lower case. ``N`` documents have a term and ``L`` terms together, a document has
    ``n``, ``m = 50 + 50 n N div L``, a term is in ``df`` documents and weighs
    ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``, and its ``tf`` occurrences add
    ``w (10^9 tf div (1000 tf + 20 m))`` to a document's score; an item's term counts
    once. Scores of 0 are left out; equal scores rank by ascending id, rows without an id
    last. Null and empty texts have no term: such an item has no rows, and such a document
    is in none. Each row is a document or item of its own, repeated ones too. An empty
    table gives an empty result; other columns are not read.

    Every document is counted in one pass; of its terms those that may be in an item (by a
    filter of fixed size) are stored. Documents are dealt into blocks of about
    ``block_docs`` by a hash of the row, so no word, however common, makes a large task: a
    task has one block's impact lists of the terms of ``chunk_items`` items and runs the
    Best Position Algorithm (:meth:`Block.best`) for each item. The ``k`` best of a block
    cover its part of the ``k`` best of all, and what blocks return is ranked once more.
    """
    wanted = kept(item_terms(items, item_id, item_text), "items")
    chunks = max(1, wanted.count() // chunk_items)
    wanted = wanted.withColumn("chunk", F.expr(f"pmod(xxhash64(item), {chunks}L)"))
    pairs = wanted.select("chunk", "item", F.explode("terms").alias("term"))
    postings = kept(counted(docs, filter_of(pairs), doc_id, text), "postings")
    n, length = postings.where("term IS NULL").agg(F.sum("tf"), F.sum("n")).first()  # one row
    n, length = n or 0, length or 0
    postings = postings.where("term IS NOT NULL")

    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).alias("w")
    weighed = pairs.join(frequency.select("term", weight).where("w > 0"), "term")
    weighed = weighed.groupBy("chunk", "item").agg(F.collect_list(F.struct("term", "w")).alias("terms"))

    # Postings go to their block as they are, so that no word is a key of a shuffle.
    blocks = max(1, -(-n // block_docs))
    left = postings.select(
        F.expr(f"pmod(xxhash64(row), {blocks}L)").alias("block"), every("chunk", chunks), "row", "doc_id", "term", "tf", "n"
    )
    right = weighed.select(
        every("for_block", blocks), F.col("chunk").alias("for_chunk"), F.col("item").alias("for_item"), "terms"
    )

    def run(postings: pa.Table, items: pa.Table) -> pa.Table:
        found = list(ranked(postings, items, k, n, length)) if len(postings) and len(items) else []
        rows = np.concatenate([rows for _, rows, _ in found]) if found else np.zeros(0, np.int64)
        return pa.table({
            "item": pa.array(np.repeat([item for item, *_ in found], [len(rows) for _, rows, _ in found]), pa.int64()),
            "doc_id": postings["doc_id"].take(pa.array(rows, pa.int64())).cast(pa.int64()),
            "score": pa.array(np.concatenate([s for *_, s in found]) if found else [], pa.int64()),
        })

    both = left.groupBy("block", "chunk").cogroup(right.groupBy("for_block", "for_chunk"))
    best = both.applyInArrow(run, "item long, doc_id long, score long")
    in_order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
    result = best.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
    result = kept(result, "ranked")
    for done in (wanted, postings):
        discarded(done)
    return result
