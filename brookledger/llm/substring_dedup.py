"""Substring dedup: remove words of repeated windows, found by difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm import shared_grams as grams
from brookledger.llm.batches import NOT_SPACE, Hasher, Texts, column, slices, small_batches

WINDOW = 20
#: A perfect difference cover: each difference modulo PERIOD is one of two members.
#: So two places of one text each reach, within PERIOD - 1 words, places of equal
#: distance ahead that are both in the cover.
PERIOD = 7
COVER = (1, 2, 4)

_FIRST, _SECOND = Hasher(31), Hasher(32)


def _owners(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return column(part, "owner").to_numpy(zero_copy_only=False), column(part, "tie").to_numpy(zero_copy_only=False)


def _entries(words: Texts, at: np.ndarray, owner: np.ndarray, length: int, part: pa.RecordBatch, whole: bool) -> grams.Entries:
    """Entries of runs of words; ``whole`` hashes (of 96 bits) decide, others only call for a closer look."""
    ids, ties = _owners(part)
    h1 = _FIRST.runs(_FIRST.words(words.text, words.starts, words.lengths), at, length)
    if whole:
        h2 = _SECOND.runs(_SECOND.words(words.text, words.starts, words.lengths), at, length) & grams.HALF
    else:
        h1, h2 = h1 & grams.SHORT, np.zeros(len(at), np.uint64)
    return {
        "h1": h1, "h2": h2, "owner": ids[owner], "tie": ties[owner],
        "place": (at - words.first[:-1][owner]).astype(np.int32), "extra": np.zeros(len(at), np.int32),
    }


def _later(entries: grams.Entries, first: np.ndarray, company: np.ndarray) -> np.ndarray:
    """Entries of a hash that also starts earlier; repeated rows of one document are the same place."""
    starts = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    same = np.ones(len(first), bool)
    for n in ("owner", "tie", "place"):
        same &= entries[n] == entries[n][starts]
    return ~same


def _in_company(entries: grams.Entries, first: np.ndarray, company: np.ndarray) -> np.ndarray:
    """What a slice has twice is repeated for sure; the entry that is sent on says so in ``extra``."""
    entries["extra"] = company.astype(np.int32)
    return company & ~first


def _list_places(entries: DataFrame) -> DataFrame:
    """The places of each document in one list; a document's own length bounds it."""
    return entries.groupBy("owner", "tie").agg(F.collect_set("place").alias("places"))


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word goes if a window of ``window`` words of its document covers it whose
    words also start earlier: in a document with a smaller id, or earlier in the
    same document. Words are runs of characters other than six blanks; null is
    a text without words. Rows that share an id are ordered by a hash of their
    text, and equal rows are one document: all get the same result. A null id
    comes after all others. Other columns are ignored.

    1. Anchors: runs of ``window - PERIOD + 1`` words that begin at places of
       the cover. If two windows are equal, they hold equal anchors at the same
       distance from their starts, so a window without a repeated anchor is new.
       Anchors meet by hash; those that occur once are forgotten.
    2. Extension: around the repeated anchors of a document all windows that
       hold one are hashed whole (96 bits), and those that are not the first of
       their hash are marked.
    3. Each document drops the words that marked windows cover.

    All exchanges are by hash, with one entry of a hash from each slice of text,
    so no group grows with the number of copies. The text itself moves once: both
    joins read the same columns of it, so they share one exchange.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_buckets = grams.buckets(docs)
    anchor = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    # Only where ids repeat do entries have to carry what tells their rows apart.
    ids = docs.groupBy(F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))).count()
    ambiguous = not ids.where("count > 1").isEmpty()
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("owner"),
        (F.xxhash64(F.col(doc_id).isNull(), F.col(text)) if ambiguous else F.lit(0).cast("long")).alias("tie"),
        F.col(text).alias("text"),
    )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words = Texts(texts)
            words.split(NOT_SPACE)
            at, owner = words.places(anchor)
            place = at - words.first[:-1][owner]
            chosen = cover[place % PERIOD] & (words.counts[owner] >= window)
            entries = _entries(words, at[chosen], owner[chosen], anchor, part, whole=False)
            yield grams.to_batch(list(grams.deal(entries, n_buckets, _in_company)))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words = Texts(texts)
            words.split(NOT_SPACE)
            lists = column(part, "places")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            repeated = np.asarray(lists.flatten(), np.int64)
            base = np.repeat(words.first[:-1], lengths)
            marks = np.zeros(len(words.starts) + window + 1, np.int64)
            # A repeated anchor at p is in the windows that begin at p - PERIOD + 1 to p.
            np.add.at(marks, np.maximum(base, base + repeated - PERIOD + 1), 1)
            np.add.at(marks, base + repeated + 1, -1)
            reached = np.cumsum(marks) > 0
            at, owner = words.places(window)
            chosen = reached[at]
            entries = _entries(words, at[chosen], owner[chosen], window, part, whole=True)
            yield grams.to_batch(list(grams.deal(entries, n_buckets, _later)))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words = Texts(texts)
            words.split(NOT_SPACE)
            marks = np.zeros(len(words.starts) + 1, np.int64)
            lists = column(part, "places")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            covered = np.asarray(lists.flatten(), np.int64) + np.repeat(words.first[:-1], lengths)
            np.add.at(marks, covered, 1)
            np.add.at(marks, covered + window, -1)
            gone = np.cumsum(marks[:-1]) > 0
            raw, kept = words.text.tobytes(), []
            for k in range(len(texts)):
                low, high = words.first[k], words.first[k + 1]
                stay = np.flatnonzero(~gone[low:high]) + low
                kept.append(b" ".join([raw[s : s + n] for s, n in zip(words.starts[stay].tolist(), words.lengths[stay].tolist())]))
            total = np.concatenate([[0], np.cumsum(gone)])[words.first]
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"), pa.array(words.counts), pa.array(np.diff(total)),
                    pa.array([k.decode() for k in kept], pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    entry = "owner long, tie long, place int"
    names = ["owner", "tie", "place"]
    sent = rows.select("owner", "tie", "text").mapInArrow(anchors, grams.ROW)
    repeated = grams.meet(sent, lambda e, first, company: company | (e["extra"] > 0), names, entry)
    # The same columns as in the last join, which then reuses this exchange of the texts.
    near = rows.join(_list_places(repeated), ["owner", "tie"]).select("doc_id", "owner", "tie", "text", "places")
    marked = grams.meet(near.mapInArrow(windows, grams.ROW), _later, names, entry)
    placed = rows.join(_list_places(marked), ["owner", "tie"], "left")
    return placed.select("doc_id", "text", "places").mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
