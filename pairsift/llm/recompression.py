"""Recompression of word sequences: equal passages get equal symbols inside.

A sequence of symbols (words at first) is shortened in rounds. A round names each
run of one symbol by the symbol and the run's length, and then each pair of a
left-sided and a right-sided symbol, the sides being a hash bit of the name. Names are
hashes of what they stand for, so all tasks name alike. Whether symbols are joined
depends on them and their neighbours only; so within a passage that occurs at several
places all symbols agree, but for some at its ends. Each symbol here knows the words
that decide about it: any window of words that holds them holds the symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAR = np.int64(1) << 40
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SALTS = [np.uint64((turn + 1) * 0xD6E8FEB86659FD93 % (1 << 64)) for turn in range(16)]
BASES = (BASE, np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def is_gap() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


GAPS = is_gap()
WORDS_AT_ONCE = 1 << 17


@dataclass
class Words:
    """The words of texts that lie behind one another in ``data``."""

    sizes: np.ndarray  # words of each text
    hashes: np.ndarray  # two 64-bit hashes of each word, as columns


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words between ASCII white space of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    letter = ~GAPS[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    # A word ends with its text.
    edges = offsets[:-1][(offsets[:-1] < len(data)) & (offsets[:-1] >= 0)]
    begins[edges] = letter[edges]
    starts = np.flatnonzero(begins)
    sizes = np.diff(np.searchsorted(starts, offsets))
    hashes = np.zeros((len(starts), 2), np.uint64)
    for first in range(0, len(starts), WORDS_AT_ONCE):
        own = starts[first : first + WORDS_AT_ONCE]
        stop = starts[first + len(own)] if first + len(own) < len(starts) else len(data)
        block = np.where(letter[own[0] : stop], data[own[0] : stop], 0).astype(np.uint64)
        own = own - own[0]
        place = np.arange(len(block)) - np.repeat(own, np.diff(np.append(own, len(block))))
        for column, base in enumerate(BASES):
            powers = np.multiply.accumulate(np.full(int(place.max()) + 1, base))
            hashes[first : first + len(own), column] = mixed(np.add.reduceat(block * powers[place], own))
    return Words(sizes, hashes)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Two 64-bit hashes of each window of ``width`` words, as columns."""
    count = max(0, len(hashes) - width + 1)
    found = np.zeros((count, 2), np.uint64)
    for column, base in enumerate(BASES):
        sums = np.zeros(count, np.uint64)
        for at in range(width):
            sums = sums * base + hashes[at : at + count, column]
        found[:, column] = mixed(sums)
    return found


@dataclass
class Symbols:
    """A level's symbols, in order: name, text, and the words ``low:high`` that decide."""

    name: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def beside(self) -> np.ndarray:
        """For each symbol but the last, whether the next one is in the same text."""
        return self.text[1:] == self.text[:-1]


def runs_named(s: Symbols) -> Symbols:
    """Runs of one symbol become one; the symbols beside a run decide where it ends."""
    joined = s.beside() & (s.name[1:] == s.name[:-1])
    first = np.flatnonzero(np.append(True, ~joined))
    last = np.append(first[1:], len(s.name)) - 1
    length = (last - first + 1).astype(np.uint64)
    name = s.name[first]
    name = np.where(length > 1, mixed(name * BASE + length), name)
    text = s.text[first]
    same_left = np.append(False, text[1:] == text[:-1])
    same_right = np.append(text[1:] == text[:-1], False)
    low = np.where(same_left, s.low[np.maximum(first - 1, 0)], -FAR)
    high = np.where(same_right, s.high[np.minimum(last + 1, len(s.name) - 1)], FAR)
    return Symbols(name, text, low, high)


def pairs_named(s: Symbols, turn: int) -> Symbols:
    """Pairs of a left and a right symbol become one; others see that they are in none."""
    right = ((mixed(s.name + SALTS[turn]) >> np.uint64(17)) & np.uint64(1)).astype(bool)
    beside = s.beside()
    starts = np.append(beside & ~right[:-1] & right[1:], False)
    second = np.append(False, starts[:-1])
    next_high = np.append(np.where(beside, s.high[1:], FAR), FAR)
    before_low = np.append(-FAR, np.where(beside, s.low[:-1], -FAR))
    # A left symbol that begins no pair sees what follows it, a right one what precedes.
    low = np.where(right & ~second, before_low, s.low)
    high = np.where(starts | ~right, next_high, s.high)
    following = np.append(s.name[1:], np.uint64(0))
    name = np.where(starts, mixed(s.name * BASE + following * BASES[1] + np.uint64(turn)), s.name)
    stays = ~second
    return Symbols(name[stays], s.text[stays], low[stays], high[stays])


def least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first:last + 1]`` for each range; ranges are not empty."""
    tables, span = [values], 1
    widest = int((last - first).max(initial=0)) + 1
    while span * 2 <= widest:
        before = tables[-1]
        tables.append(np.minimum(before, np.append(before[span:], before[-1:].repeat(span))[: len(before)]))
        span *= 2
    size = (last - first + 1).astype(np.int64)
    level = np.floor(np.log2(size)).astype(np.int64)
    found = np.empty(len(first), np.uint64)
    for at, table in enumerate(tables):
        chosen = level == at
        found[chosen] = np.minimum(table[first[chosen]], table[last[chosen] - (1 << at) + 1])
    return found


class Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.base = self.inverse = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.base) <= count:
            size = 2 * count + 1
            self.base = np.multiply.accumulate(np.append(np.uint64(1), np.full(size, BASE)))
            self.inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(size, INVERSE)))
        return self.base[: count + 1], self.inverse[: count + 1]


POWERS = Powers()


def window_keys(hashes: np.ndarray, sizes: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each window of ``width`` words of each text: ``starts, keys``.

    ``hashes`` are the word hashes of all texts behind one another, ``sizes`` their
    numbers of words, ``starts`` places in ``hashes``. The key is the hash of the words
    that decide about a symbol of the window: of the symbols of the highest level that
    has any in the window, the one with the least hash. It depends on the window's
    words only, and windows that follow one another mostly share it.
    """
    total = len(hashes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    starts = np.flatnonzero(np.arange(total) + width <= ends)
    keys = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return starts, keys
    powers, inverse = POWERS.upto(total)
    prefix = np.append(np.uint64(0), np.cumsum(hashes * powers[:-1]))
    at = np.arange(total, dtype=np.int64)
    levels = [Symbols(hashes, text, at, at + 1)]
    for turn in range(rounds):
        levels.append(pairs_named(runs_named(levels[-1]), turn))
    open_ = np.ones(len(starts), bool)
    for level in reversed(levels):
        inside = level.high - level.low <= width
        low, high = level.low[inside], level.high[inside]
        if not len(low):
            continue
        value = mixed((prefix[high] - prefix[low]) * inverse[low] + (high - low).astype(np.uint64))
        todo = np.flatnonzero(open_)
        first = np.searchsorted(low, starts[todo])
        last = np.searchsorted(high, starts[todo] + width, side="right") - 1
        held = last >= first
        keys[todo[held]] = least_between(value, first[held], last[held])
        open_[todo[held]] = False
    return starts, keys
