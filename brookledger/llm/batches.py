"""Words and their hashes for Arrow batches of text, as whole-array operations.

Everything here works on the UTF-8 bytes of many texts at once. A slice holds
at most ``SLICE_BYTES`` of text (or one longer text), which bounds the memory
of a task whatever the length of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 2_000_000
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8_000_000))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def byte_table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


NOT_SPACE = ~byte_table(SPACES)
#: Bytes of words made of digits, lower-case letters and all that is not ASCII.
ALPHANUMERIC = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


def _random_table(seed: int, size: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(np.full(size, seed, np.uint64)))


class Hasher:
    """A 64-bit hash of byte strings and of runs of them; the seed picks one of a family."""

    def __init__(self, seed: int):
        self.bytes = _random_table(seed, 256)
        odd = _random_table(seed + 1_000_003, 2) | np.uint64(1)
        self.step, self.run_step = odd[0], odd[1]
        self.run_step_inverse = np.uint64(pow(int(odd[1]), -1, 1 << 64))
        self.powers = np.ones(1, np.uint64)

    def _powers_to(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            steps = np.full(2 * n, self.step, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
        return self.powers

    def words(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hash of each word text[start : start + length]; words do not overlap."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        firsts = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
        values = self.bytes[text[np.repeat(starts, lengths) + within]]
        values *= self._powers_to(int(lengths.max()))[within]
        return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))

    def runs(self, words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Hash of words[i : i + length] for each i of ``at``."""
        if not len(at):
            return np.zeros(0, np.uint64)
        back = np.full(len(words), self.run_step_inverse, np.uint64)
        steps = np.full(len(words), self.run_step, np.uint64)
        back[0] = steps[0] = 1
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * np.multiply.accumulate(steps), out=total[1:])
        return mix((total[at + length] - total[at]) * np.multiply.accumulate(back)[at])


class Texts:
    """Some texts as one array of bytes; ``bounds`` has where each begins, and the end."""

    def __init__(self, column: pa.Array, lower: bool = False):
        offsets = np.frombuffer(column.buffers()[1], np.int32 if column.type == pa.string() else np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
        self.text = LOWER[raw] if lower else raw
        self.bounds = offsets - offsets[0]

    def split(self, members: np.ndarray) -> None:
        """Find the words: longest runs of bytes that ``members`` has, within a text.

        Sets starts, lengths, and ``first``: the index of each text's first word, and the end.
        """
        inside = members[self.text]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        inner = self.bounds[(self.bounds >= 0) & (self.bounds < len(inside))]
        before[inner] = False
        ends = self.bounds[self.bounds > 0] - 1
        after[ends] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.lengths = np.flatnonzero(inside & ~after) + 1 - self.starts
        self.first = np.searchsorted(self.starts, self.bounds)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def places(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all runs of ``length`` words inside one text, and the text of each."""
        per_text = np.maximum(self.counts - length + 1, 0)
        owner = np.repeat(np.arange(len(per_text)), per_text)
        shift = np.cumsum(per_text) - per_text
        return np.arange(len(owner)) - shift[owner] + self.first[:-1][owner], owner


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches with at most SLICE_BYTES of text, and their texts; null becomes empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        slot = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                part = batch.slice(low, high - low)
                yield part, pc.fill_null(column.slice(low, high - low), "")


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed values of a Spark long."""
    return np.ascontiguousarray(x).view(np.int64)
