"""Quality classifier: how much better a text compresses with a dictionary of good than of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import column, slices, small_batches
from brookledger.llm.labelled import fold, sampled

#: Learned documents of each label, bytes of a dictionary, and compression level.
PER_LABEL = 3000
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass
class Model:
    """Two dictionaries and a logistic curve over the features of ``features``."""

    bad: bytes
    good: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def __post_init__(self):
        self.compressors = None

    def __getstate__(self):
        return {**self.__dict__, "compressors": None}

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Normalised difference of the compressed sizes, compressed share, log of the length."""
        if self.compressors is None:
            self.compressors = []
            for content in (self.bad, self.good):
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(level=LEVEL)
                self.compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
        bad, good = (len(c.compress(text)) for c in self.compressors)
        return (bad - good) / (bad + good), min(bad, good) / (len(text) + 16), float(np.log1p(len(text)))

    def score(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.centre) / self.scale
        z = np.column_stack([np.ones(len(x)), x]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a little ridge, by Newton's method; classes weigh as they occur."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """Parts of many texts in turn, the last ones being the cheapest to refer to."""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"\n".join(texts)[-size:] or b" "


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", per_label: int = PER_LABEL) -> Model | None:
    """The model from labelled rows outside the held-out fold; None if a label is missing.

    Fitted on a bounded sample of about ``per_label`` whole texts of each label,
    drawn by a hash of the id. Half of it makes the dictionaries, the other half
    the curve, so the curve sees texts that the dictionaries did not.
    """
    small_batches(docs.sparkSession)
    marked = labels.select(F.col(doc_id).alias("id"), F.col(quality).alias("quality")).where(
        F.col("quality").isin(0, 1) & F.col("id").isNotNull() & (fold(F.col("id"), 3) != 1)
    ).distinct()
    n = {r[0]: r[1] for r in marked.groupBy("quality").count().collect()}
    # About 2 * per_label rows of an id and a label: small enough for every executor, whatever the table's size.
    chosen = F.broadcast(sampled(marked, "quality", "id", per_label))
    rows = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
        .join(chosen, "id").select("id", "quality", "text").orderBy("id", "text").collect()
    )
    parts: dict[tuple[int, int], list[bytes]] = {(q, h): [] for q in (0, 1) for h in (0, 1)}
    for k, r in enumerate(rows):
        parts[r["quality"], k % 2].append(r["text"].encode())
    if not all(parts.values()):
        return None
    model = Model(_dictionary(parts[0, 0], DICTIONARY_BYTES), _dictionary(parts[1, 0], DICTIONARY_BYTES), np.zeros(4), np.zeros(3), np.ones(3))
    x = np.array([model.features(t) for q in (0, 1) for t in parts[q, 1]])
    y = np.repeat([0.0, 1.0], [len(parts[0, 1]), len(parts[1, 1])])
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic((x - model.centre) / model.scale, y)
    # The sample has other shares of the labels than the table: move the curve to the table's.
    model.weights[0] += np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return model


def quality(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Only the whole text counts; null is an empty text. Without a model (nothing
    learned) every score is 0.5. Null ids stay null, repeated rows are repeated,
    other columns are ignored. By row, without a shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, texts in slices(batches):
            if model is None:
                score = np.full(len(texts), 0.5)
            else:
                score = model.score(np.array([model.features(t.as_buffer().to_pybytes()) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (fold(F.col(doc_id), 3) == 1).alias("held_out"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, score double, predicted int")
