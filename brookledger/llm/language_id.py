"""Language ID by prediction by partial matching with frozen statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import LOWER, Texts, column, slices, small_batches
from brookledger.llm.labelled import fold, sampled
from brookledger.llm.row_keys import free_names
from brookledger.llm.worker_memory import turn_of

#: Bytes of context of the deepest level.
ORDER = 3
#: Learned documents of each language.
PER_LANGUAGE = 1500
#: Bits of a byte that no context predicts: all 256 are alike.
RAW_BITS = 8.0
#: Bytes that are scored at a time, so that a long text takes no more memory than a short one.
BLOCK = 1 << 18
UNKNOWN = "und"


def _grams(texts: Texts, symbol: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER symbols before it; before a text begins stands symbol 0."""
    s = symbol[texts.text].astype(np.int64)
    at = np.arange(len(s)) - np.repeat(texts.bounds[:-1], np.diff(texts.bounds))
    code = np.zeros(len(s), np.int64)
    for back in range(ORDER, 0, -1):
        code *= 256
        code[back:] += np.where(at[back:] >= back, s[:-back], 0)
    return code * 256 + s


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        langs = column(part, "lang").to_pylist()
        for lang in set(langs):
            own = texts.filter(pa.array([x == lang for x in langs]))
            grams, n = np.unique(_grams(Texts(own), LOWER), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])


@dataclass
class Level:
    """Contexts of one length: what they predict for each language, in bits.

    The symbols seen after a context are marked in words of 64 bits; a row of
    ``cost`` is found by counting marks, so that a context costs no more memory
    than it has symbols, and all contexts are kept.
    """

    context: np.ndarray  # of all symbol strings of this length: its index, or -1
    words: int  # of marks for each context
    marks: np.ndarray  # of (index, word)
    before: np.ndarray  # of (index, word): marks in all words before it
    escape: np.ndarray  # of (index, language)
    cost: np.ndarray  # of (row, language)

    def row(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Rows of symbols after contexts of these indices, or -1."""
        if not len(self.cost):
            return np.full(len(at), -1)
        word = at.astype(np.int64) * self.words + (symbol >> 6)
        held, bit = self.marks[word], np.uint64(1) << (symbol & 63).astype(np.uint64)
        place = self.before[word] + np.bitwise_count(held & (bit - np.uint64(1)))
        return np.where((at >= 0) & (held & bit != 0), place, -1)


class Model:
    """Context trees of all languages side by side, laid out as arrays for lookups.

    A symbol seen in a context costs -log2(c / (n + u)) bits, with c its count,
    n the count of the context and u its number of different symbols; any other
    costs the escape, -log2(u / (n + u)), and what the next shorter context
    asks for it. A context that a language never had asks nothing. These are
    exact code lengths of method C with no further updates.
    """

    def __init__(self, languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.languages = languages
        used = np.unique(np.concatenate([(gram >> (8 * k)) & 255 for k in range(ORDER + 1)])) if len(gram) else np.zeros(0, np.int64)
        self.symbol = np.zeros(256, np.int64)  # 0: the start, and bytes that were never seen
        used = used[used != 0]
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.symbol = self.symbol[LOWER]
        self.size = len(used) + 1
        dense = np.zeros_like(gram)
        for k in range(ORDER, -1, -1):
            dense = dense * self.size + self.symbol[(gram >> (8 * k)) & 255]
        self.counts = (lang, dense, n)
        self.levels: list[Level] | None = None

    def __getstate__(self):
        return {**self.__dict__, "levels": None}

    def build(self) -> "Model":
        """Lay out the levels; done once in each Python worker."""
        if self.levels is None:
            lang, dense, n = self.counts
            self.levels = []
            for order in range(ORDER + 1):
                self.levels.append(self._level(order, lang, dense % self.size ** (order + 1), n))
        return self

    def _level(self, order: int, lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Level:
        size, width = self.size, len(self.languages)
        context_of, symbol_of = gram // size, gram % size
        contexts, index = np.unique(context_of, return_inverse=True)
        where = np.full(size**order, -1, np.int32)
        where[contexts] = np.arange(len(contexts), dtype=np.int32)
        cells, cell = np.unique(index * size + symbol_of, return_inverse=True)
        words = -(-size // 64)
        marks = np.zeros(len(contexts) * words, np.uint64)
        marked = cells % size
        np.bitwise_or.at(marks, cells // size * words + (marked >> 6), np.uint64(1) << (marked & 63).astype(np.uint64))
        seen = np.bitwise_count(marks).astype(np.int64)
        before = (np.cumsum(seen) - seen).astype(np.int32)
        count = np.zeros((len(cells), width))
        np.add.at(count, (cell, lang), n)
        owner = cells // size
        all_n, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(all_n, owner, count)
        np.add.at(kinds, owner, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(all_n > 0, -np.log2(kinds / (all_n + kinds)), 0.0)
            cost = -np.log2(count / (all_n + kinds)[owner])
        lower = self._cost(order - 1, contexts[owner] % max(1, size ** (order - 1)), cells % size)
        cost = np.where(count > 0, cost, escape[owner] + lower)
        return Level(where, words, marks, before, escape.astype(np.float32), cost.astype(np.float32))

    def _cost(self, order: int, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Bits of symbols after contexts, for each language, from the level of this order down."""
        if order < 0:
            return np.full((len(context), len(self.languages)), RAW_BITS, np.float32)
        level = self.levels[order]
        at = level.context[context]
        row = level.row(at, symbol)
        missing = np.flatnonzero(row < 0)
        out = level.cost[row] if len(level.cost) else np.zeros((len(row), len(self.languages)), np.float32)
        if len(missing):
            short = context[missing] % max(1, self.size ** (order - 1))
            below = self._cost(order - 1, short, symbol[missing])
            known = at[missing] >= 0
            below[known] += level.escape[at[missing][known]]
            out[missing] = below
        return out

    def bits(self, texts: Texts) -> np.ndarray:
        """Code length of each text under each language, worked out in blocks of BLOCK bytes."""
        size, n = self.size, len(texts.text)
        symbols = self.symbol[texts.text].astype(np.int32)
        at = np.minimum(np.arange(n) - np.repeat(texts.bounds[:-1], np.diff(texts.bounds)), ORDER).astype(np.int8)
        out = np.zeros((len(texts.bounds) - 1, len(self.languages)))
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK)
            context = np.zeros(high - low, np.int64)
            for back in range(ORDER, 0, -1):
                context *= size
                skip = max(0, back - low)  # places without so many symbols before them
                before = symbols[low + skip - back : high - back]
                context[skip:] += np.where(at[low + skip : high] >= back, before, 0)
            cost = self._cost(ORDER, context, symbols[low:high])
            total = np.zeros((high - low + 1, cost.shape[1]))
            np.cumsum(cost, axis=0, dtype=np.float64, out=total[1:])
            cuts = np.clip(texts.bounds, low, high) - low
            out += total[cuts[1:]] - total[cuts[:-1]]
        return out


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """The model from rows with a text and a language, outside the held-out fold.

    It is fitted on a bounded sample: about ``per_language`` whole texts of each
    language, drawn by a hash of the id; all contexts met in it are kept.
    Counting is done by Spark; the driver gets counts of byte strings of that
    sample only.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    chosen = sampled(rows, "lang", "doc_id", per_language).select("lang", "text")
    counted = chosen.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    code = {x: k for k, x in enumerate(languages)}
    counted = counted.sort_values(["lang", "gram"])
    return Model(languages, counted["lang"].map(code).to_numpy(np.int64), counted["gram"].to_numpy(np.int64), counted["n"].to_numpy(np.int64))


def _verdicts(model: Model, part: pa.RecordBatch, texts: pa.Array, letter: str = "_has_letter") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits a byte of each text of a slice."""
    seen = Texts(texts)
    lengths = np.diff(seen.bounds)
    letters = column(part, letter).to_numpy(zero_copy_only=False)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), RAW_BITS)
    bits = model.build().bits(seen)
    best = bits.argmin(axis=1)
    least = bits.min(axis=1)
    # Chance of the best language when the evidence of n bytes counts as that of sqrt(n).
    weight = np.exp2(-(bits - least[:, None]) / np.sqrt(np.maximum(lengths, 1))[:, None])
    score = np.where(letters, 1 / weight.sum(axis=1), 0.0)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
    return names, score, least / np.maximum(lengths, 1)


def _with_letter(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def language_id(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, bits_per_byte.

    The language whose trees code the whole text in the fewest bits, the first
    in order where they tie; ``und`` with score 0 for a null text, one without
    a letter, or when nothing was learned. Only the text is an input. Null ids
    stay null, repeated rows are repeated, other columns are ignored. By row,
    without a shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            names, score, bits = _verdicts(shared.value, part, texts)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        (fold(F.col(doc_id), 4) == 2).alias("held_out"), _with_letter(F.col(text)).alias("_has_letter"),
    )
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def in_known_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with their own columns, whose text is in a learned language.

    Rejected are texts that are null or without a letter, and those that every
    language codes in as many bits as raw bytes take, or more.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    (letter,) = free_names(names, "_has_letter")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of("language_id")
        for part, texts in slices(batches, text):
            langs, _, bits = _verdicts(shared.value, part, texts, letter)
            good = pa.array([x != UNKNOWN for x in langs]) if len(langs) else pa.array([], pa.bool_())
            mask = np.logical_and(good.to_numpy(zero_copy_only=False), bits < RAW_BITS)
            yield part.select(names).filter(pa.array(mask))

    return docs.withColumn(letter, _with_letter(F.col(text))).mapInArrow(keep, docs.schema)
