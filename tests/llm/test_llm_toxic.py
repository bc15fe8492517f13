"""Toxic passages: segments against brute force, held-out accuracy, awkward rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SCHEMA, awkward_rows

from brookledger.llm.toxic_passages import Model, forms, learn, maximal_segments, toxicity

SF = "/root/testdata/sf0.1"


def slow_segments(scores: list[float], at: int = 0) -> list[tuple[int, int, float]]:
    """By definition: the best segment (shortest, if several), then the same on both sides of it."""
    best = max(((sum(scores[i:j]), i - j, -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return [*slow_segments(scores[:i], at), (at + i, at + j - 1, best[0]), *slow_segments(scores[j:], at + j)]


def test_segments_equal_the_definition():
    draw = random.Random(3)
    for _ in range(300):
        n, loss = draw.randint(1, 18), draw.choice([0.3, 1.1, 2.7])
        places = sorted(draw.sample(range(n), draw.randint(1, n)))
        gains = [draw.random() * 3 + 0.01 for _ in places]
        scores = [-loss] * n
        for p, g in zip(places, gains):
            scores[p] = g
        found = maximal_segments(places, gains, loss)
        expected = slow_segments(scores)
        assert [x[:2] for x in found] == [x[:2] for x in expected]
        assert np.allclose([x[2] for x in found], [x[2] for x in expected])


def test_longest_learned_form_decides():
    model = Model({b"los*": 2.0, b"lost*": 0.0, b"scum": 3.0}, 0.5)
    assert [model.score_of(w) for w in (b"loser", b"losted", b"lost", b"scum", b"scu", b"xy")] == [2.0, 0.0, 2.0, 3.0, 0.0, 0.0]
    assert forms(b"loser") == [b"loser", b"lose*", b"los*"] and forms(b"lo") == []
    counts, found = model.passages(pa.array(["A loser, SCUM! fine losted words", "", "scum"]))
    assert counts.tolist() == [6, 0, 1]
    assert found[0] == [(1, 2, 5.0)] and found[1] == [] and found[2] == [(0, 0, 3.0)]


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, learn(docs, labels)


def test_held_out_documents(spark, learned):
    docs, labels, model = learned
    rows = toxicity(docs, model).join(labels, "doc_id").where("held_out").select("toxic", "score", "predicted", "passages").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in clean]) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([len(r.passages) > 0 for r in toxic]) > 0.85


def test_scores_equal_plain_python(spark, learned):
    """Words, segments and calibration again, one document at a time."""
    import re

    docs, _, model = learned
    rows = docs.limit(60).collect()
    found = {r.doc_id: r for r in toxicity(docs.limit(60), model).collect()}
    for r in rows:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r.text or "").encode()))
        scores = [model.score_of(w) for w in words]
        segments = maximal_segments([k for k, s in enumerate(scores) if s > 0], [s for s in scores if s > 0], model.loss)
        logs = [-math.log(model.scale * max(len(words), 1) * math.exp(-model.decay * s)) for _, _, s in segments]
        best = max(logs, default=-math.log(model.scale * max(len(words), 1)))
        total = math.log1p(sum(x for x in logs if x > -math.log(0.05)))
        z = model.weights @ [1, min(max(best, -20), 20) / 10, total]
        assert found[r.doc_id].n_words == len(words)
        assert found[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_awkward_rows_and_nothing_to_learn(spark, learned):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    rows = toxicity(docs, learned[2]).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.passages == [] for r in rows if r.n_words == 0)
    labels = spark.createDataFrame([(1, None, 1), (2, 1, 1), (None, 0, 1)], "doc_id long, toxic int, quality int")
    assert learn(docs, labels) is None
    assert {r.score for r in toxicity(docs, None).collect()} == {0.0}
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity(empty, learned[2]).count() == 0 and learn(empty, labels) is None
