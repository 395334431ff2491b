"""Lengths of texts in greedy word pieces, by a linear longest-match automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsift.llm.byte_bpe import Memo
from pairsift.llm.common import whole_text

ROOT, NOWHERE = 0, -1
LONG = 64


class PieceCounter:
    """Counts the pieces of a word without building them.

    A trie of the vocabulary whose nodes know, for the case that the word leaves the
    trie there: how many pieces greedy matching has certainly cut off the letters
    read (``popped``), and the node for the letters left over (``fail``). So a word
    is read once, letter by letter, and failures only ever shorten what is left.
    """

    def __init__(self, vocabulary: Iterable[str]):
        self.steps: list[dict[str, int]] = [{}]
        ends = {self._insert(piece) for piece in vocabulary if piece}
        self.fail = [NOWHERE] * len(self.steps)
        self.popped = [0] * len(self.steps)
        level = [ROOT]
        while level:
            following = []
            for node in level:
                for letter, child in self.steps[node].items():
                    following.append(child)
                    if child in ends:
                        self.fail[child], self.popped[child] = ROOT, 1
                    else:
                        self._link(node, letter, child)
            level = following

    def _insert(self, piece: str) -> int:
        node = ROOT
        for letter in piece:
            if letter not in self.steps[node]:
                self.steps[node][letter] = len(self.steps)
                self.steps.append({})
            node = self.steps[node][letter]
        return node

    def _link(self, parent: int, letter: str, child: int) -> None:
        cut, rest = self.popped[parent], self.fail[parent]
        while rest != NOWHERE and letter not in self.steps[rest]:
            cut, rest = cut + self.popped[rest], self.fail[rest]
        if rest != NOWHERE:
            self.fail[child], self.popped[child] = self.steps[rest][letter], cut

    def count(self, word: str) -> int:
        """Pieces of ``word``; 0 if it cannot be cut into pieces."""
        steps, fail, popped = self.steps, self.fail, self.popped
        node, pieces = ROOT, 0
        for letter in word:
            while letter not in steps[node]:
                pieces += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return 0
            node = steps[node][letter]
        while node != ROOT:
            pieces += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return 0
        return pieces


COUNTERS: dict[str, tuple[PieceCounter, Memo]] = {}


def count_pieces(
    docs: DataFrame,
    vocabulary: Iterable[str],
    name: str,
    start: str = "▁",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every row of ``docs``.

    Words stand between ASCII white space and are cut greedily, ``start`` + word,
    into the longest pieces of the vocabulary from left to right. A word that cannot
    be cut counts as one token and as unknown. ``name`` identifies the vocabulary in
    the workers. A null or empty text has no words. Rows that repeat give rows that
    repeat; an empty table gives an empty result; other columns are not read.
    Nothing is shuffled; the vocabulary is broadcast, and a worker remembers a
    bounded number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sorted(set(vocabulary)))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in COUNTERS:
            counter = PieceCounter(shared.value)
            COUNTERS[name] = counter, Memo(lambda word: counter.count(start + word.decode()))
        counter, memo = COUNTERS[name]
        for batch in batches:
            rows = []
            for body in batch.column(1):
                words = body.as_py().encode().split()
                pieces = [
                    memo[word] if len(word) <= LONG else counter.count(start + word.decode())
                    for word in words
                ]
                unknown = pieces.count(0)
                rows.append((len(words), sum(pieces) + unknown, unknown))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(counts, "doc_id long, n_words long, n_tokens long, n_unknown long")
