"""Substring deduplication: words of passages that an earlier document has are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsift.llm.common import kept, whole_text
from pairsift.llm.recompression import window_hashes, window_keys, words_of
from pairsift.stages import discarded

LAST = (1 << 63) - 1  # the place of rows without an id: after all others
BYTES_AT_ONCE = 2_000_000
WINDOWS_AT_ONCE = 1 << 16
SPAN_BITS = 12  # of a span's length; its first window stands above


def texts_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a batch's texts: first row, row after the last, their bytes and offsets."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BYTES_AT_ONCE, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans_of(hashes: np.ndarray, sizes: np.ndarray, width: int, rounds: int) -> Iterator[tuple]:
    """``text, key, span`` arrays: the keys of the texts' windows, one per stretch.

    A long text is taken in overlapping parts, which changes nothing: a window's key
    depends on the window alone.
    """
    begin = np.cumsum(sizes) - sizes
    cut = [
        (text, at, min(size, at + WINDOWS_AT_ONCE + width - 1))
        for text, size in enumerate(sizes.tolist())
        for at in range(0, max(1, size - width + 1), WINDOWS_AT_ONCE)
    ]
    while cut:
        # Parts one after another, up to the size of one long part.
        count, words = 0, 0
        while count < len(cut) and (count == 0 or words < WINDOWS_AT_ONCE):
            words += cut[count][2] - cut[count][1]
            count += 1
        part, cut = cut[:count], cut[count:]
        lengths = np.array([stop - start for _, start, stop in part])
        joined = np.concatenate([hashes[begin[t] + start : begin[t] + stop] for t, start, stop in part])
        starts, keys = window_keys(joined, lengths, width, rounds)
        if not len(starts):
            continue
        piece = np.repeat(np.arange(len(part)), lengths)[starts]
        moved = np.array([start for _, start, _ in part]) - (np.cumsum(lengths) - lengths)
        place = starts + moved[piece]
        new = np.flatnonzero(
            np.append(True, (keys[1:] != keys[:-1]) | (piece[1:] != piece[:-1]))
        )
        # A stretch is at most as long as its bits can say.
        lengths = np.diff(np.append(new, len(keys)))
        most = (1 << SPAN_BITS) - 1
        pieces = -(-lengths // most)
        again = np.repeat(np.arange(len(new)), pieces)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = new[again]
        count = np.minimum(lengths[again] - nth * most, most)
        text = np.array([t for t, _, _ in part])[piece[first]]
        yield text, keys[first].view(np.int64), ((place[first] + nth * most) << SPAN_BITS) | count


def evidence(texts: DataFrame, width: int, rounds: int) -> DataFrame:
    """``key, place, span``: what the windows of each text (``place, text``) hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(0).to_numpy()
            for first, last, data, offsets in texts_of(batch.column(1)):
                words = words_of(data, offsets)
                for text, key, span in spans_of(words.hashes[:, 0], words.sizes, width, rounds):
                    columns = [key, places[first:last][text], span]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], ["key", "place", "span"]
                    )

    return texts.select("place", "text").mapInArrow(rows, "key long, place long, span long")


def firsts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows of one text: where each different one is first, and which one each is."""
    _, first, which = np.unique(hashes[:, 0], return_index=True, return_inverse=True)
    return first, which


def windows(texts: DataFrame, width: int) -> DataFrame:
    """``h1, h2, place, text_hash, at``: the windows in the ``spans`` of each text.

    A window that a text repeats comes once, where it is first.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, names = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, last, data, offsets in texts_of(batch.column(2)):
                words = words_of(data, offsets)
                begin = np.cumsum(words.sizes) - words.sizes
                for row in range(first, last):
                    size = words.sizes[row - first]
                    if size < width:
                        continue
                    own = words.hashes[begin[row - first] : begin[row - first] + size]
                    spans = batch.column(3)[row].values.to_numpy()
                    change = np.zeros(size + 2, np.int64)
                    start = np.minimum(spans >> SPAN_BITS, size)
                    stop = np.minimum(start + (spans & ((1 << SPAN_BITS) - 1)), size)
                    np.add.at(change, start, 1)
                    np.add.at(change, stop, -1)
                    hashes = window_hashes(own, width)
                    chosen = np.flatnonzero(np.cumsum(change)[: len(hashes)] > 0)
                    at = chosen[firsts(hashes[chosen])[0]]
                    found = hashes[at].view(np.int64)
                    columns = [
                        found[:, 0],
                        found[:, 1],
                        np.full(len(at), places[row]),
                        np.full(len(at), names[row]),
                        at,
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], ["h1", "h2", "place", "text_hash", "at"]
                    )

    return texts.select("place", "text_hash", "text", "spans").mapInArrow(
        rows, "h1 long, h2 long, place long, text_hash long, at long"
    )


def covered(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Which words of a text lie in windows equal to those that begin at ``at``."""
    words = words_of(data, np.array([0, len(data)]))
    hashes = window_hashes(words.hashes, width)
    first, which = firsts(hashes)
    gone = np.isin(first, at)[which]
    change = np.zeros(len(words.hashes) + 1, np.int64)
    starts = np.flatnonzero(gone)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change)[:-1] > 0


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def shortened(texts: DataFrame, width: int, with_text: bool) -> DataFrame:
    """The result for each text, of ``copy`` (a whole earlier text) and ``at`` (windows)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(len(batch)):
                body = batch.column(1)[row].as_py().encode()
                words = body.split()
                count, at = len(words), batch.column(3)[row]
                if count >= width and batch.column(2)[row].as_py():
                    words = []
                elif count >= width and at.is_valid:
                    gone = covered(np.frombuffer(body, np.uint8), at.values.to_numpy(), width)
                    words = [word for word, out in zip(words, gone.tolist()) if not out]
                left = b" ".join(words)
                found.append(
                    (count, count - len(words), hashlib.sha256(left).hexdigest(), left.decode() if with_text else None)
                )
            columns = list(zip(*found)) if found else [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return texts.select("doc_id", "text", "copy", "at").mapInArrow(rows, RESULT)


def dedup(
    docs: DataFrame,
    width: int = 13,
    rounds: int = 2,
    with_text: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every row of ``docs``.

    A window is ``width`` consecutive words (between ASCII white space, unchanged) of
    one text. Every word is removed that a window covers whose word sequence also
    starts in a document with a smaller id; all windows are judged on the input.
    ``kept_text`` are the words left with single spaces between them, null unless
    ``with_text``. A null text has no words. Rows without an id come after all with
    one and remove nothing from each other; neither do rows with one id. Rows that
    repeat give rows that repeat; an empty table gives an empty result; other columns
    are not read.

    First, texts that equal an earlier one are settled by their digest. Of the others
    every stretch of windows sends the key that recompression gives it (about one row
    per four words); windows whose key two documents share are hashed whole (128
    bits) and compared. Equal windows have equal keys, so none is lost.
    """
    body = whole_text(text)
    place = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    all_texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        place.alias("place"),
        F.xxhash64(body).alias("text_hash"),
        body.alias("text"),
    )
    digests = kept(all_texts.select("place", "text_hash", F.md5("text").alias("digest")), "digests")
    first = digests.groupBy("digest").agg(F.min("place").alias("first"))
    copies = kept(
        digests.join(first, "digest").where("place > first").select("place", "text_hash").distinct(), "copies"
    )
    texts = all_texts.join(copies, ["place", "text_hash"], "left_anti")

    found = kept(evidence(texts, width, rounds), "evidence")
    shared = found.groupBy("key").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b")
    # A key may be in many documents: plain joins, whose large partitions adaptive
    # execution splits.
    spans = found.join(shared.select("key"), "key").groupBy("place").agg(F.collect_list("span").alias("spans"))
    spans = kept(spans, "spans")
    discarded(found)

    seen = kept(windows(all_texts.join(spans, "place"), width), "windows")
    least = seen.groupBy("h1", "h2").agg(F.min("place").alias("least"))
    later = seen.join(least, ["h1", "h2"]).where("least < place")
    marks = later.groupBy("place", "text_hash").agg(F.collect_list("at").alias("at"))
    whole = copies.select("place", "text_hash", F.lit(True).alias("copy"), F.lit(None).cast("array<bigint>").alias("at"))
    gone = kept(whole.unionByName(marks.withColumn("copy", F.lit(False))), "marks")
    for done in (seen, spans, copies, digests):
        discarded(done)

    decided = all_texts.join(gone, ["place", "text_hash"], "left")
    return shortened(decided.withColumn("copy", F.coalesce("copy", F.lit(False))), width, with_text)
