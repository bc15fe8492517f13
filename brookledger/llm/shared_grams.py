"""Which hashed word runs occur more than once: exchanged as packed blocks, not as rows.

Each slice of text gives its runs as entries (hash of 128 bits, owner, place).
Entries are dealt over buckets by their hash; what a slice sends to a bucket is
one row of arrays. Inside a slice, entries of one hash are reduced to the first
one before they are sent, and the others are marked as repeated right there, so
that a run as common as a third of all documents is one entry of a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields of an entry: hash (two halves), owner (order and tie), place, and a number that goes with it.
ENTRY = [("h1", "<u8"), ("h2", "<u8"), ("owner", "<i8"), ("tie", "<i8"), ("place", "<i4"), ("extra", "<i4")]
NAMES = [n for n, _ in ENTRY]
ROW = "bucket int, sent binary, settled binary"
Entries = dict[str, np.ndarray]
#: A hash that only calls for a closer look needs fewer bits; so does the second half of one that decides.
SHORT, HALF = np.uint64((1 << 48) - 1), np.uint64((1 << 32) - 1)


def buckets(df: DataFrame) -> int:
    """Four to a shuffle partition, so that one fits a task where partitions do."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def take(entries: Entries, which) -> Entries:
    return {n: entries[n][which] for n in NAMES}


def join(parts: list[Entries]) -> Entries:
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, t) for n, t in ENTRY}


def pack(entries: Entries) -> bytes:
    """Field after field, and of each field first all lowest bytes, then all next ones.

    So what is equal, slowly rising or zero lies together, and the exchange's
    own compression takes it away: unused fields cost next to nothing.
    """
    planes = []
    for n, t in ENTRY:
        values = np.ascontiguousarray(entries[n], t)
        planes.append(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())
    return b"".join(planes)


def unpack(raw: bytes) -> Entries:
    n, at, out = len(raw) // sum(np.dtype(t).itemsize for _, t in ENTRY), 0, {}
    for name, t in ENTRY:
        width = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out[name] = np.ascontiguousarray(planes.T).view(t).reshape(n)
        at += n * width
    return out


def first_of_each(entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, is the first of its hash, has company), by hash, owner, tie and place."""
    order = np.lexsort((entries["place"], entries["tie"], entries["owner"], entries["h2"], entries["h1"]))
    h1, h2 = entries["h1"][order], entries["h2"][order]
    first = np.ones(len(order), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(order)))
    return order, first, np.repeat(sizes > 1, sizes)


def deal(entries: Entries, n_buckets: int, settle: Callable[[Entries, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
    """Rows for the buckets. ``settle`` says which sorted entries are final already; it may note something in ``extra``."""
    order, first, company = first_of_each(entries)
    ordered = take(entries, order)
    final = settle(ordered, first, company)
    sent, settled = take(ordered, first), take(ordered, final)
    bucket = (sent["h1"] % np.uint64(n_buckets)).astype(np.int64)
    # Settled entries need no meeting: any bucket does, chosen by owner.
    other = (settled["tie"].astype(np.int64) ^ settled["owner"]) % n_buckets
    # Inside a bucket by owner, so that neighbours are alike and compress.
    by = np.lexsort((sent["place"], sent["owner"], bucket))
    by_other = np.lexsort((settled["place"], settled["owner"], other))
    cuts = np.searchsorted(bucket[by], np.arange(n_buckets + 1))
    cuts_other = np.searchsorted(other[by_other], np.arange(n_buckets + 1))
    for b in range(n_buckets):
        lo, hi, lo2, hi2 = cuts[b], cuts[b + 1], cuts_other[b], cuts_other[b + 1]
        if hi > lo or hi2 > lo2:
            yield b, pack(take(sent, by[lo:hi])), pack(take(settled, by_other[lo2:hi2]))


def to_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
        ["bucket", "sent", "settled"],
    )


def meet(rows: DataFrame, keep: Callable[[Entries, np.ndarray, np.ndarray], np.ndarray], names: list[str], schema: str) -> DataFrame:
    """Bring the entries of each bucket together; rows of those that ``keep`` picks, and of the settled ones."""

    def of_bucket(frame: pd.DataFrame) -> pd.DataFrame:
        sent = join([unpack(x) for x in frame["sent"]])
        settled = join([unpack(x) for x in frame["settled"]])
        order, first, company = first_of_each(sent)
        ordered = take(sent, order)
        out = join([take(ordered, keep(ordered, first, company)), settled])
        return pd.DataFrame({n: out[n].view(np.int64) if out[n].dtype == np.uint64 else out[n] for n in names})

    return rows.groupBy("bucket").applyInPandas(of_bucket, schema)
