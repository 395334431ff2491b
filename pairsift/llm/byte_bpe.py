"""Byte-level BPE by prefix dynamic programming: encoding, appending, editing, decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator, Mapping

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.llm.common import whole_text

# Finds that a memo of a Python worker keeps, and as many of the time before.
MEMO = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file, one ``base64 rank`` per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Memo(dict):
    """A dictionary that forgets what was not asked for during its last ``MEMO`` finds."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Vocabulary:
    """Tokens of a byte-level BPE and which of them may stand side by side.

    Merging goes by rank, so two tokens can be neighbours only if no merge across
    the border between them would have come before the merges that made the two.
    ``fits`` tells that for a pair; a sequence of tokens is the encoding of its bytes
    exactly if all its neighbouring pairs fit.
    """

    def __init__(self, ranks: Mapping[bytes, int]):
        self.ranks = dict(ranks)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks), default=1)
        self.top = max(self.tokens, default=0) + 1
        # Finds all tokens that end at each byte; bytes are taken as Latin-1 letters.
        self.matches = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.matches.add_word(token.decode("latin-1"), (len(token), rank))
        self.matches.make_automaton()
        self._edges: dict[tuple[int, int], list[int]] = {}
        self.fits = Memo(self._never_merge)

    def merged(self, text: bytes, below: int) -> list[bytes]:
        """``text`` after all merges of a rank lower than ``below``, lowest first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            options = [
                (self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1)
            ]
            rank, i = min(options)
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edge(self, token: int, side: int) -> list[int]:
        """What stands at one end of ``token`` while it grows: a byte, ..., the token."""
        known = self._edges.get((token, side))
        if known is None:
            parts = self.merged(self.tokens[token], token)
            inner = self.edge(self.ranks[parts[side]], side) if len(parts) == 2 else []
            known = self._edges[token, side] = [*inner, token]
        return known

    def _never_merge(self, pair: int) -> bool:
        """Whether the tokens ``divmod(pair, top)`` stay two when they are neighbours."""
        left, right = divmod(pair, self.top)
        ranks, tokens, never = self.ranks, self.tokens, self.top
        before, after = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            grow_left = before[i + 1] if i + 1 < len(before) else never
            grow_right = after[j + 1] if j + 1 < len(after) else never
            across = ranks.get(tokens[before[i]] + tokens[after[j]], never)
            # Of equal ranks the leftmost merge comes first.
            if across < grow_left and across <= grow_right and across < never:
                return False
            if grow_left == grow_right == never:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1


class PrefixTable:
    """For each prefix of a byte string, the last token of its encoding.

    That token is unique: of the tokens that the prefix ends with, exactly one fits
    behind the encoding of what is before it. So the table grows byte by byte, the
    encoding is read off backwards, and an edit leaves the table before it as it is.
    """

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary, self.text = vocabulary, b""
        self.last: list[int] = [-1]
        self.length: list[int] = [0]
        self.append(text)

    def append(self, more: bytes) -> None:
        """Encodes ``more`` behind the text; nothing before is encoded again."""
        done, self.text = len(self.text), self.text + more
        self.last += [-1] * len(more)
        self.length += [0] * len(more)
        self._fill(done, len(self.text))

    def _fill(self, done: int, stop: int) -> None:
        """Last tokens of the prefixes longer than ``done``, up to ``stop`` bytes."""
        vocabulary, last, length = self.vocabulary, self.last, self.length
        fits, top = vocabulary.fits, vocabulary.top
        # A token may begin before the bytes that are new.
        base = max(0, done - vocabulary.longest)
        for at, (size, token) in vocabulary.matches.iter(self.text[base:stop].decode("latin-1")):
            end = base + at + 1
            if last[end] < 0:
                start = end - size
                if not start or fits[last[start] * top + token]:
                    last[end] = token
                    length[end] = size

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Puts ``new`` for the bytes from ``start`` to ``end``.

        Behind the edit the table is computed, a longest token's length at a time,
        until it agrees with the old one over such a length; from there on the old
        one holds.
        """
        old_last, old_length = self.last, self.length
        self.text = self.text[:start] + new + self.text[end:]
        more = len(self.text) - start
        self.last = old_last[: start + 1] + [-1] * more
        self.length = old_length[: start + 1] + [0] * more
        shift, done, step = len(new) - (end - start), start, self.vocabulary.longest
        while done < len(self.text):
            stop = min(len(self.text), max(done, start + len(new)) + step)
            self._fill(done, stop)
            block = slice(stop - step + 1, stop + 1)
            before = slice(stop - step + 1 - shift, stop + 1 - shift)
            if (
                stop - step >= start + len(new) + step
                and self.last[block] == old_last[before]
                and self.length[block] == old_length[before]
            ):
                self.last[stop + 1 :] = old_last[stop + 1 - shift :]
                self.length[stop + 1 :] = old_length[stop + 1 - shift :]
                return
            done = stop

    def encoding(self) -> list[int]:
        found, end = [], len(self.text)
        while end:
            found.append(self.last[end])
            end -= self.length[end]
        return found[::-1]


class Codec:
    """Encodes and decodes whole texts, each match of a pattern on its own.

    A text is cut at single spaces between two visible characters, where a match of
    the pattern must begin; the same chunks and matches come again and again, so
    what they are encoded to is remembered. ``pattern`` has to take a single space
    to the word behind it, and to end no match inside of white space otherwise.
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")
    LONG = 64

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.matched = Memo(lambda match: PrefixTable(self.vocabulary, match.encode()).encoding())
        # A chunk stands for itself with the space before it.
        self.chunk = Memo(lambda chunk: self._outcome(" " + chunk))

    def ids(self, text: str) -> list[int]:
        found: list[int] = []
        for match in self.pattern.findall(text):
            if len(match) <= self.LONG:
                found += self.matched[match]
            else:
                found += PrefixTable(self.vocabulary, match.encode()).encoding()
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def _outcome(self, text: str) -> tuple[int, bytes, bytes]:
        ids = self.ids(text)
        return len(ids), b" ".join([b"%d" % x for x in ids]), self.decode(ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal, SHA-256 of what they decode to."""
        first, *rest = self.CUT.split(text)
        chunk, outcome, long = self.chunk, self._outcome, self.LONG
        found = [outcome(first)] if first else []
        found += [chunk[x] if len(x) <= long else outcome(" " + x) for x in rest]
        ids = hashlib.sha256(b" ".join([x[1] for x in found]))
        decoded = hashlib.sha256(b"".join([x[2] for x in found]))
        return sum([x[0] for x in found]), ids.hexdigest(), decoded.hexdigest()


CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(ranks, path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file, built once; ``ranks`` is its broadcast."""
    if (path, pattern) not in CODECS:
        CODECS[path, pattern] = Codec(ranks.value, pattern)
    return CODECS[path, pattern]


def broadcast_ranks(spark: SparkSession, path: str):
    """The rank file's content for all workers; only the driver reads the file."""
    return spark.sparkContext.broadcast(read_ranks(path))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digests(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    The ids are those of the rank file at ``path``, special tokens being ordinary
    text. A null or empty text has no ids and decodes to nothing. Rows that repeat
    give rows that repeat; an empty table gives an empty result; other columns are
    not read. Nothing is shuffled. The vocabulary is read by the driver and broadcast;
    its size is that of the file. A worker's memos are bounded
    by :data:`MEMO`.
    """
    ranks = broadcast_ranks(docs.sparkSession, path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, path, pattern)
        for batch in batches:
            found = [codec.digest(text.as_py()) for text in batch.column(1)]
            columns = list(zip(*found)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(digests, DIGESTS)


def encode_ids(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, ids``: the token ids themselves; as :func:`encode_digests` otherwise."""
    ranks = broadcast_ranks(docs.sparkSession, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, path, pattern)
        for batch in batches:
            ids = [codec.ids(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    ranks = broadcast_ranks(encoded.sparkSession, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, path, "")
        for batch in batches:
            texts = [codec.decode(ids.as_py() or []).decode("utf-8", "replace") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
