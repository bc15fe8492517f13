"""Licence scan: ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brookledger.llm.batches import ALPHANUMERIC, Texts, column, slices, small_batches
from brookledger.llm.license_rules import BASE_PHRASES, build_rules, words_pattern

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<start_word:long,end_word:long,label:string,priority:int>>"
)


@functools.cache
def _compiled():
    rules = [(p, label, re.compile(pattern), word) for p, label, pattern, word in build_rules()]
    base = [(label, re.compile(words_pattern(phrase)), max(phrase.split(), key=len)) for phrase, label in BASE_PHRASES.items()]
    words: dict[str, list[int]] = {}
    for k, rule in enumerate(rules):
        words.setdefault(rule[3], []).append(k)
    for k, (_, _, word) in enumerate(base):
        words.setdefault(word, []).append(-k - 1)
    automaton = ahocorasick.Automaton()
    for word, which in words.items():
        automaton.add_word(word, tuple(which))
    automaton.make_automaton()
    return rules, base, automaton


Found = tuple[int, int, int, str]


def suppress(found: list[Found]) -> list[Found]:
    """Detections (start, end, priority, label) that no other one contains or outranks.

    Of detections on the same span the smallest priority stays, then the first
    label in order; what another contains goes. Of two that overlap otherwise,
    the one of smaller priority suppresses the other, unless it is suppressed
    itself; with equal priority both stay.
    """
    outer: list[Found] = []
    reach = -1
    # By start, longer first: whatever contains a detection comes before it, so
    # the furthest end placed so far decides.
    for one in sorted(set(found), key=lambda d: (d[0], -d[1], d[2], d[3])):
        if one[1] > reach:
            outer.append(one)
            reach = one[1]
    # Starts and ends both rise now, so those that overlap one lie next to it.
    kept: set[int] = set()
    for k in sorted(range(len(outer)), key=lambda k: outer[k][2]):
        if not any(j in kept and outer[j][2] < outer[k][2] for j in _overlapping(outer, k)):
            kept.add(k)
    return [outer[k] for k in sorted(kept)]


def _overlapping(outer: list[Found], k: int) -> Iterator[int]:
    j = k - 1
    while j >= 0 and outer[j][1] > outer[k][0]:
        yield j
        j -= 1
    j = k + 1
    while j < len(outer) and outer[j][0] < outer[k][1]:
        yield j
        j += 1


def detect(text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, str]]]:
    """Detections of all rules after suppression, and places of the base phrases, in a lower-cased text."""
    rules, base, automaton = _compiled()
    wanted: set[int] = set()
    for _, which in automaton.iter(text):
        wanted.update(which)
    found, places = [], []
    for k in sorted(wanted):
        if k < 0:
            label, pattern, _ = base[-k - 1]
            places += [(*m.span(), label) for m in pattern.finditer(text)]
        else:
            priority, label, pattern, _ = rules[k]
            found += [(*m.span(), priority, label) for m in pattern.finditer(text)]
    return suppress(found), places


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        words = Texts(texts, lower=True)
        words.split(ALPHANUMERIC)
        raw = words.text.tobytes()
        columns: list[list] = [[] for _ in range(8)]
        for k in range(len(texts)):
            low, high = int(words.bounds[k]), int(words.bounds[k + 1])
            text = raw[low:high].decode("utf-8")
            found, places = detect(text)
            starts = words.starts[words.first[k] : words.first[k + 1]] - low
            ascii_only = len(text) == high - low

            def word_at(at: int) -> int:
                """Index of the word that begins at or after this character."""
                return int(np.searchsorted(starts, at if ascii_only else len(text[:at].encode())))

            at = sorted(word_at(s) for s, _, _ in places)
            base_labels = {label for _, _, label in places}
            spans = [{"start_word": word_at(s), "end_word": word_at(e), "label": label, "priority": p} for s, e, p, label in found]
            covered = np.zeros(len(starts) + 1, bool)
            for s in spans:
                covered[s["start_word"] : max(s["end_word"], s["start_word"] + 1)] = True
            labels = base_labels | {label for *_, label in found}
            values = (
                len(starts), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted(base_labels)),
                ",".join(sorted(labels)), float(covered[: len(starts)].sum() / len(starts)) if len(starts) else 0.0, spans,
            )
            for c, v in zip(columns, values):
                c.append(v)
        spans_type = pa.list_(pa.struct([("start_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans_type]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        yield pa.RecordBatch.from_arrays(
            [column(part, "doc_id").cast(pa.int64())] + [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", *names]
        )


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: words, places of base phrases, labels, score, spans.

    Works on the whole lower-cased text (A-Z only); null is an empty text, with
    no words, empty labels, score 0 and null positions. score is the share of
    the words that detections cover. spans are the detections that no
    other one contains or, by priority, suppresses, in words. A null id stays null, repeated rows are
    repeated, other columns are ignored. The work is by row; no shuffle.
    """
    small_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(_scan, SCHEMA)
