"""Token ids of many words at once, remembering words seen before in this Python worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all runs start, start + 1, ... of these lengths, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Numbers:
    """Numbers different 64-bit keys 0, 1, ... in the order they are added.

    An open table has the number of a key at the key's place, or at the first
    place after it that was free. At most half of the places are taken.
    """

    STEP = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self):
        self.n, self.bits = 0, 12
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.table = np.full(1 << self.bits, -1, np.int32)

    def __len__(self) -> int:
        return self.n

    def _places(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * self.STEP) >> np.uint64(64 - self.bits)).view(np.int64)

    def _enter(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        at, mask = self._places(keys), (1 << self.bits) - 1
        while len(at):
            free = self.table[at] < 0
            self.table[at[free]] = numbers[free]
            left = self.table[at] != numbers  # taken before, or by another of these keys
            at, numbers = (at[left] + 1) & mask, numbers[left]

    def add(self, keys: np.ndarray) -> None:
        """Keys that differ from each other and from those that are there."""
        first, self.n = self.n, self.n + len(keys)
        while self.n > len(self.keys):
            self.keys = np.resize(self.keys, 2 * len(self.keys))
        self.keys[first : self.n] = keys
        if 2 * self.n > len(self.table):
            while 2 * self.n > 1 << self.bits:
                self.bits += 1
            self.table, first = np.full(1 << self.bits, -1, np.int32), 0
        self._enter(self.keys[first : self.n], np.arange(first, self.n, dtype=np.int32))

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of keys, -1 for a key that is not there."""
        at, mask = self._places(keys), (1 << self.bits) - 1
        out = self.table[at]
        wrong = np.flatnonzero((self.keys[out] != keys) & (out >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & mask
            out[wrong] = self.table[at[wrong]]
            found = out[wrong]
            wrong = wrong[(self.keys[found] != keys[wrong]) & (found >= 0)]
        return out


class _Words:
    """Ids of words, in one array; a word's number leads to its place there."""

    def __init__(self):
        self.numbers = Numbers()
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.flat, self.used = np.zeros(8192, np.uint32), 0

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.numbers)
        while first + len(keys) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.numbers.add(keys)
        self.lengths[first : first + len(keys)] = lengths
        self.starts[first : first + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers].astype(np.int64)
        return self.flat[ragged(self.starts[numbers], lengths)], lengths


class WordCache:
    """Maps a word's key to its ids.

    When ``limit`` words are held they become the old generation, and what it
    held before is forgotten; words still in use move on to the new one. What is
    remembered makes no difference to the result.
    """

    def __init__(self, limit: int = 400_000):
        self.limit = limit
        self.new, self.old = _Words(), _Words()

    def _numbers(self, keys: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of all words in the new generation."""
        numbers = self.new.numbers.get(keys)
        unknown = np.flatnonzero(numbers < 0)
        if not len(unknown):
            return numbers
        different, first = np.unique(keys[unknown], return_index=True)
        if len(self.new.numbers) and len(self.new.numbers) + len(different) > self.limit:
            self.old, self.new = self.new, _Words()
            unknown = np.arange(len(keys))
            different, first = np.unique(keys, return_index=True)
        before = self.old.numbers.get(different)
        known = before >= 0
        if known.any():
            self.new.add(different[known], *self.old.get(before[known]))
        if not known.all():
            self.new.add(different[~known], *encode(unknown[first[~known]]))
        numbers[unknown] = self.new.numbers.get(keys[unknown])
        return numbers

    def ids(self, keys: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word).

        ``encode`` gets indices into ``keys``, one word for each key not known,
        and returns the same for them.
        """
        numbers = self._numbers(keys, encode)
        return self.new.get(numbers)  # only now: the generation may have changed

    def places(self, keys: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Like ``ids``, as (an array, where each word's ids begin in it, number of ids of each word); holds until the next call."""
        numbers = self._numbers(keys, encode)
        return self.new.flat, self.new.starts[numbers], self.new.lengths[numbers].astype(np.int64)
