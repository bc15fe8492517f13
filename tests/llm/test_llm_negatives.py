"""Hard negatives against brute force: cover tree, windows, awkward vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookledger.llm import hard_negatives as hn
from brookledger.llm.hard_negatives import Best, CoverTree, augmented, hard_negatives, product_bounds

SCHEMA = "vec_id long, embedding array<float>, label int, node string, centre string, k string, square string, raw string"


def answer(rows: list[tuple], every: int = 100) -> set[tuple]:
    """rows: (id, vector, label) that take part."""
    whole = {(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in x), y) for i, x, y in rows}
    out = set()
    for i, x, y in whole:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, z)), j, w) for j, z, w in whole if j != i and len(z) == len(x)]
        for p, j, _ in sorted(s for s in scored if s[2] == y)[:5]:
            inside = sorted((n, m) for n, m, w in scored if w != y and 80 * -p <= 100 * -n <= 100 * -p)
            out |= {(i, j, rank, m, -p, -n) for rank, (n, m) in enumerate(inside[:5], 1)}
    return out


def mine(spark, rows, every=100):
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    return [tuple(r) for r in hard_negatives(df, F.col("vec_id") % every == 0).collect()]


def check(spark, rows, every=100):
    found = mine(spark, rows, every)
    assert len(found) == len(set(found))
    good = [r for r in rows if None not in r and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    assert set(found) == answer(good, every)


@pytest.fixture
def small_cells(monkeypatch):
    """Many centres, cells and tree levels on few rows."""
    for name, value in (("PER_CENTRE", 60), ("MEMBERS", 40), ("ANCHORS", 10), ("LEAF", 4), ("CHILDREN", 5)):
        monkeypatch.setattr(hn, name, value)


def test_clusters_ties_and_norms(spark, small_cells):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, 16))
    x = centres[draw.integers(0, 6, 600)] + draw.normal(size=(600, 16)) * 0.2 * draw.random((600, 1))
    x *= draw.random((600, 1)) * 2  # norms differ
    x[100:200] = x[100]  # a crowd of equal vectors
    check(spark, [(i, v.tolist(), int(draw.integers(0, 3))) for i, v in enumerate(x)], every=20)


def test_awkward_rows(spark, small_cells):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, [0.5, 1.0], 1), (100, [0.5, 1.0], 1), (1, [1.0, 0.4], 2), (2, [0.9, 0.5], 2), (3, None, 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2),
        (6, [inf, 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (9, [1.0, 1.0, 1.0], 1), (200, [1.0, 1.0, 1.0], 2), (10, [1.0, 1.0, 0.99], 1), (11, [0.9, 1.0, 1.0], 2),
        (300, [-1.0, -1.0], 1), (400, [0.0, 0.0], 3), (12, [0.0, 0.0], 3), (13, [0.001, 0.0], 4), (14, [1e30, 1e30], 1), (15, [1e18, 1e18], 2),
    ]
    wide = {14, 15}
    check(spark, [r for r in rows if r[0] not in wide])
    assert mine(spark, rows)  # scores beyond a long do not break it
    assert mine(spark, []) == [] and mine(spark, [(100, [1.0], 1)]) == []


def test_registered_query_equals_brute_force(spark):
    from brookledger.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    found = {tuple(r) for r in QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.001").collect()}
    assert found and found == answer(rows)


def test_bounds_hold_for_every_candidate():
    draw = np.random.default_rng(6)
    x = np.floor(draw.normal(size=(500, 8)) * 100 * draw.random((500, 1)))
    q = np.floor(draw.normal(size=(20, 8)) * 100)
    largest = float(np.sqrt((x * x).sum(axis=1)).max())
    points = augmented(x, largest)
    assert np.allclose((points**2).sum(axis=1), largest**2)
    for c in range(0, 500, 50):
        near = np.argsort(((points - points[c]) ** 2).sum(axis=1))[:60]
        radius = np.sqrt(((points[near] - points[c]) ** 2).sum(axis=1)).max()
        low, high = product_bounds(q, points[c][None], np.array([radius]), largest)
        scores = q @ x[near].T
        assert (scores >= low).all() and (scores <= high).all()


def test_the_tree_skips_nodes_outside_the_window(monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 64)
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(40, 16))
    x = np.floor(256 * (centres[draw.integers(0, 40, 8000)] + 0.02 * draw.normal(size=(8000, 16))))
    ids, labels = np.arange(8000), draw.integers(0, 2, 8000)
    tree = CoverTree(x, ids, labels, float(np.sqrt((x * x).sum(axis=1)).max()))
    looked = []
    plain = CoverTree.scores
    monkeypatch.setattr(CoverTree, "scores", lambda self, node, q, exact: looked.append(node.high - node.low) or plain(self, node, q, exact))
    best = Best(-(1 << 62), 1 << 62, 5)
    tree.search(x[0], 0, labels[0], True, [best])
    scores = x @ x[0]
    mine = [(int(-scores[i]), i) for i in range(1, 8000) if labels[i] == labels[0]]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == sorted(mine)[:5]
    assert sum(looked) < 1500
