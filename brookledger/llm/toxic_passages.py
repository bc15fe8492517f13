"""Toxicity: maximum-scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import ALPHANUMERIC, Texts, column, slices, small_batches
from brookledger.llm.labelled import fold
from brookledger.llm.quality_zstd import _logistic
from brookledger.llm.shared_folder import written

#: Learned documents of each label at most (about), by a hash of the id.
PER_LABEL = 12_000
#: Bytes of the prefixes that count as forms of a word beside the word itself.
PREFIXES = (3, 4, 5, 6)
#: Strength of the Dirichlet prior, in documents, that a form has in either label.
PRIOR = 40.0
#: A form is evidence from this log-odds on, if it is as many deviations from zero.
MIN_LOG_ODDS, MIN_DEVIATIONS = 1.0, 4.0
#: Documents that must hold a longer form before it speaks for itself instead of its prefix.
MIN_DOCUMENTS = 3
#: Expected number of passages as good in clean text below which a passage is significant.
SIGNIFICANT = 0.05
SPANS = "array<struct<first_word: long, last_word: long, score: double, expected: double>>"


def forms(word: bytes) -> list[bytes]:
    """The word and its prefixes (ended by a star), longest first; words under 3 bytes have none."""
    if len(word) < PREFIXES[0]:
        return []
    return [word, *(word[:k] + b"*" for k in reversed(PREFIXES) if k < len(word))]


def words_of(texts: pa.Array) -> Texts:
    """Words: longest runs of digits, letters a to z (A to Z lower-cased) and all that is not ASCII."""
    out = Texts(texts, lower=True)
    out.split(ALPHANUMERIC)
    return out


def maximal_segments(places: list[int], scores: list[float], loss: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in linear time.

    Only the places with a positive score are given; every other place counts
    ``-loss``. The candidates are kept in a list with their running totals
    before and after; a new one is merged with the nearest earlier one that
    begins lower, if that one does not end higher.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, total before, total after, earlier candidate that begins lower
    total, at = 0.0, 0
    for place, score in zip(places, scores):
        total -= loss * (place - at)
        first, before, after = place, total, total + score
        total, at = after, place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append((first, place, before, after, j))
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, after - before) for first, last, before, after, _ in found]


@dataclass
class Model:
    """Scores of the forms, what other words count, and how scores become a probability."""

    scores: dict[bytes, float]
    loss: float
    decay: float = 1.0
    scale: float = 1.0
    weights: np.ndarray | None = None

    def __post_init__(self):
        self.prepared = None

    def __getstate__(self):
        return {**self.__dict__, "prepared": None}

    def score_of(self, word: bytes) -> float:
        """Log-odds of the longest form that was learned; 0 for a word without one."""
        return next((self.scores[x] for x in forms(word) if x in self.scores), 0.0)

    def positives(self, words: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(indices of the words that score above zero, their scores)."""
        if self.prepared is None:
            begins = np.zeros(1 << 24, bool)
            for x, score in self.scores.items():
                if score > 0:
                    begins[x[0] << 16 | x[1] << 8 | x[2]] = True
            self.prepared = begins, {}
        begins, known = self.prepared
        if len(known) > 1_000_000:
            known.clear()
        long = np.flatnonzero(words.lengths >= PREFIXES[0])
        at = words.starts[long]
        head = words.text[at].astype(np.int64) << 16 | words.text[at + 1].astype(np.int64) << 8 | words.text[at + 2]
        maybe = long[begins[head]]
        if not len(maybe):
            return maybe, np.zeros(0)
        raw = words.text.tobytes()
        scores = np.zeros(len(maybe))
        ends = (words.starts[maybe] + words.lengths[maybe]).tolist()
        for k, (s, e) in enumerate(zip(words.starts[maybe].tolist(), ends)):
            word = raw[s:e]
            score = known.get(word)
            if score is None:
                score = self.score_of(word)
                if len(word) < 64:
                    known[word] = score
            scores[k] = score
        return maybe[scores > 0], scores[scores > 0]

    def passages(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """(number of words, maximal segments) of each text."""
        words = words_of(texts)
        where, scores = self.positives(words)
        bounds = np.searchsorted(where, words.first)
        out = []
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            out.append(maximal_segments((where[a:b] - words.first[k]).tolist(), scores[a:b].tolist(), self.loss) if b > a else [])
        return words.counts, out

    def expected(self, n_words: float, score: float) -> float:
        """Segments with this score or more that as many words of clean text hold in the mean."""
        return self.scale * max(n_words, 1) * math.exp(-self.decay * score)

    def evidence(self, n_words: int, segments: list[tuple[int, int, float]]) -> tuple[float, float]:
        """(surprise of the best segment, sum of the surprises of all significant ones), as -log of what is expected."""
        each = [-math.log(max(self.expected(n_words, s), 1e-300)) for _, _, s in segments]
        best = max(each, default=-math.log(self.expected(n_words, 0.0)))
        total = sum(x for x in each if x > -math.log(SIGNIFICANT))
        return max(best, -20.0), math.log1p(total)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(evidence)), np.clip(evidence[:, 0], -20, 20) / 10, evidence[:, 1]])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


# ---- learning ----------------------------------------------------------------
def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's different forms, with its label."""
    for part, texts in slices(batches):
        words, toxic = words_of(texts), column(part, "toxic").to_pylist()
        raw = words.text.tobytes()
        for k, y in enumerate(toxic):
            a, b = words.first[k], words.first[k + 1]
            spans = zip(words.starts[a:b].tolist(), (words.starts[a:b] + words.lengths[a:b]).tolist())
            found = list({f for w in {raw[s:e] for s, e in spans} for f in forms(w)})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([y] * len(found), pa.int32())], ["form", "toxic"])


def log_odds(in_toxic: Column, in_clean: Column, n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """(log-odds ratio, its deviations from zero) of a form's documents, with a Dirichlet prior.

    The prior holds PRIOR documents of each label, shared out as the form is
    over both labels together.
    """
    share = (in_toxic + in_clean) / F.lit(float(n_toxic + n_clean))
    one, other = in_toxic + F.lit(PRIOR) * share, in_clean + F.lit(PRIOR) * share
    ratio = F.log(one / (F.lit(n_toxic + PRIOR + 1.0) - one)) - F.log(other / (F.lit(n_clean + PRIOR + 1.0) - other))
    return ratio, ratio / F.sqrt(1 / one + 1 / other)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", per_label: int = PER_LABEL) -> Model | None:
    """The model from labelled rows outside the held-out fold; None if a label is missing.

    Fitted on about ``per_label`` documents of each label at most, drawn by a
    hash of the id; equal texts of a label count once. One half gives the
    log-odds, the other, which they have not seen, the extreme-value and the
    logistic curve. Only forms that are evidence, and longer ones that speak for
    themselves, come to the driver; texts do not.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & (fold(F.col("id"), 4) != 2)
    ).distinct()
    n = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return None
    draw = F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1 << 52)) / float(1 << 52)
    limit = F.when(F.col("toxic") == 1, F.lit(per_label / n[1])).otherwise(F.lit(per_label / n[0]))
    # About 2 * per_label short rows: small enough for every executor, whatever the table's size.
    chosen = F.broadcast(marked.where(draw < limit))
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    rows = own.join(chosen, "id").select("toxic", "text", F.xxhash64("text").alias("content")).dropDuplicates(["toxic", "content"])
    half = F.pmod(F.col("content"), F.lit(2))
    first, second = rows.where(half == 0).select("toxic", "text"), rows.where(half == 1).select("toxic", "text")

    counted = {r[0]: r[1] for r in first.groupBy("toxic").count().collect()}
    if not (counted.get(0) and counted.get(1)):
        return None
    held = first.mapInArrow(_held, "form binary, toxic int").groupBy("form").agg(
        F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean"))
    held = written(held, "forms")
    ratio, deviations = log_odds(F.col("in_toxic"), F.col("in_clean"), counted[1], counted[0])
    evidence = held.where((ratio >= MIN_LOG_ODDS) & (deviations >= MIN_DEVIATIONS)).select("form", ratio.alias("score"))
    # A longer form with enough clean documents and no evidence speaks for itself: its words are not judged by the prefix.
    star = F.lit(b"*")
    prefixes = F.array(*[F.concat(F.substring("form", 1, k), star) for k in PREFIXES])
    harmless = held.where((ratio < MIN_LOG_ODDS) & (F.col("in_clean") >= MIN_DOCUMENTS)).select("form", F.explode(prefixes).alias("prefix"))
    harmless = harmless.join(evidence.select(F.col("form").alias("prefix")), "prefix", "left_semi").select("form").distinct()
    scores = {bytes(r[0]): r[1] for r in evidence.unionAll(harmless.select("form", F.lit(0.0))).collect()}
    model = Model(scores, 0.01)

    # What words of either label score, by token.
    spread = first.mapInArrow(_spread(spark.sparkContext.broadcast(model)), "toxic int, score double, n long").groupBy("toxic", "score").agg(F.sum("n").alias("n")).collect()
    tokens = {y: {r["score"]: r["n"] for r in spread if r["toxic"] == y} for y in (0, 1)}
    other = [(tokens[y].get(0.0, 0) + 1) / (sum(tokens[y].values()) + 2) for y in (0, 1)]
    model.loss = max(0.01, math.log(other[0] / other[1]))
    model.decay = _decay(tokens[0], model.loss)

    seen = second.mapInArrow(_segments(spark.sparkContext.broadcast(model)), "toxic int, n_words long, segments array<double>").collect()
    clean = [r for r in seen if r["toxic"] == 0]
    # With the right scale, scale * n * exp(-decay * best) is exponential with mean 1 over clean texts.
    spread_of_best = sum(max(r["n_words"], 1) * math.exp(-model.decay * max(r["segments"], default=0.0)) for r in clean)
    model.scale = max(len(clean), 1) / max(spread_of_best, 1e-9)
    x = np.array([model.evidence(r["n_words"], [(0, 0, s) for s in r["segments"]]) for r in seen]).reshape(-1, 2)
    y = np.array([float(r["toxic"]) for r in seen])
    if not 0 < y.sum() < len(y):
        return None
    model.weights = _logistic(np.column_stack([np.clip(x[:, 0], -20, 20) / 10, x[:, 1]]), y)
    # The sample has other shares of the labels than the table: move the curve to the table's.
    model.weights[0] += math.log(n[1] / n[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return model


def _spread(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words, toxic = words_of(texts), column(part, "toxic").to_numpy()
            where, scores = shared.value.positives(words)
            owner = np.searchsorted(words.first, where, side="right") - 1
            for y in (0, 1):
                values, n = np.unique(scores[toxic[owner] == y], return_counts=True)
                rest = int(words.counts[toxic == y].sum() - n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([y] * (len(n) + 1), pa.int32()), pa.array([0.0, *values.tolist()]), pa.array([rest, *n.tolist()])], ["toxic", "score", "n"])

    return run


def _segments(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            counts, found = shared.value.passages(texts)
            yield pa.RecordBatch.from_arrays(
                [column(part, "toxic"), pa.array(counts.astype(np.int64)), pa.array([[s for _, _, s in x] for x in found], pa.list_(pa.float64()))],
                ["toxic", "n_words", "segments"])

    return run


def _decay(clean: dict[float, int], loss: float) -> float:
    """The positive root of mean(exp(root * score)) = 1 over words of clean text; 1, as for exact log-odds, if there is none up to 4."""
    scores = np.array([s if s > 0 else -loss for s in clean])
    share = np.array([float(n) for n in clean.values()])
    share /= max(share.sum(), 1.0)
    if not len(scores) or share @ scores >= 0 or share @ np.exp(4 * scores) <= 1:
        return 1.0
    low, high = 1e-6, 4.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if share @ np.exp(middle * scores) < 1 else (low, middle)
    return high


# ---- scoring -----------------------------------------------------------------
def toxicity(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_words, passages.

    ``passages`` has every significant maximal segment of the whole text: first
    and last word (from 0), score, and how many as good clean text of this
    length would hold in the mean. Null is an empty text and has none; without
    a model (nothing learned) every score is 0. Null ids stay null, repeated
    rows are repeated, other columns are ignored. By row, without a shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, texts in slices(batches):
            if model is None:
                counts, found, score = words_of(texts).counts, [[]] * len(texts), np.zeros(len(texts))
            else:
                counts, found = model.passages(texts)
                score = model.probability(np.array([model.evidence(n, x) for n, x in zip(counts.tolist(), found)]))
            spans = [
                [(a, b, s, e) for a, b, s in x if (e := model.expected(n, s)) < SIGNIFICANT] if x else [] for n, x in zip(counts.tolist(), found)]
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32)),
                 pa.array(counts.astype(np.int64)), pa.array([[dict(zip(("first_word", "last_word", "score", "expected"), t)) for t in x] for x in spans], kind)],
                ["doc_id", "held_out", "score", "predicted", "n_words", "passages"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (fold(F.col(doc_id), 4) == 2).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id long, held_out boolean, score double, predicted int, n_words long, passages {SPANS}")
