"""Dedup operators against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm_cases import SCHEMA, awkward_rows, groups, jaccard_answer, sample_rows, substring_answer

from brookledger.llm.components import components
from brookledger.llm.exact_dedup import exact_dedup, without_copies
from brookledger.llm.jaccard_join import jaccard_components, one_of_each_group
from brookledger.llm.pq_neardup import Index, near_duplicates
from brookledger.llm.substring_dedup import substring_dedup


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(30)] + [(7, 7), (500, 499)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: v for k, v in groups([x for x in links if x[0] != x[1]]).items()}


# ---- exact dedup -------------------------------------------------------------
def test_exact_dedup_of_awkward_rows(awkward):
    rows = exact_dedup(awkward, fan_in=2).collect()
    assert len(rows) == 16
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [by[1][0]["keep_id"], by[2][0]["keep_id"]] == [1, 2]  # letters' case counts
    assert {by[k][0]["keep_id"] for k in (3, 4, 5)} == {5} and by[3][0]["group_size"] == 3
    assert sorted(r["kept"] for r in by[8]) == [False, True] and by[8][0]["group_size"] == 2
    assert by[None][0]["keep_id"] is None and by[None][0]["kept"]


def test_exact_dedup_prefers_code_points_then_the_smaller_id(spark):
    docs = spark.createDataFrame([(3, "a b"), (1, "ab"), (2, "a b"), (None, "a b")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["kept"], r["group_size"]) for r in exact_dedup(docs).collect()} == {
        (3, 2, False, 4), (1, 2, False, 4), (2, 2, True, 4), (None, 2, False, 4)}


def test_exact_dedup_uses_no_python(awkward):
    assert "Python" not in exact_dedup(awkward)._jdf.queryExecution().toString()


def test_exact_dedup_merges_sorted_runs_in_rounds(spark):
    """64 runs at four a round: three exchanges, each between a sort with its combining pass and a merge of what arrives."""
    docs = spark.createDataFrame([(k, f"text {k % 50 if k % 3 else 0}") for k in range(640)], "doc_id long, text string").repartition(64)
    found = exact_dedup(docs, fan_in=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate(") == 6 and plan.count("HashAggregate(") == 0
    want: dict = {}
    for r in docs.collect():
        want.setdefault(r["text"].replace(" ", ""), []).append((-len(r["text"]), r["doc_id"]))
    assert {(r["keep_id"], r["group_size"]) for r in found.collect()} == {(min(g)[1], len(g)) for g in want.values()}


def test_without_copies_keeps_columns(awkward, empty):
    kept = without_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14]
    assert without_copies(empty).count() == 0


# ---- substring dedup -----------------------------------------------------------
def test_substring_dedup_of_the_sample(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in sample_rows())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(docs).collect()}
    assert got == substring_answer(rows)


def test_substring_dedup_of_awkward_rows(awkward, empty):
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup(awkward).collect()}
    assert {(3, 0, 0), (4, 0, 0), (5, 0, 0), (8, 1, 0), (6, 60_000, 60_000 - _new_words(60_000)), (10, 34, 0), (11, 35, 30), (13, 60, 60)} <= got
    assert substring_dedup(empty).count() == 0


def _new_words(n: int) -> int:
    from llm_cases import LONG, substring_answer

    return n - substring_answer([(6, LONG)])[6][1]


def test_substring_dedup_treats_repeated_rows_as_one_document(spark):
    text = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in substring_dedup(docs).collect())
    assert got == [(1, 0), (1, 0), (2, 50), (99, 50)]


# ---- Jaccard join ---------------------------------------------------------------
def test_jaccard_join_of_the_sample(spark):
    rows = [(r["doc_id"], r["text"]) for r in sample_rows()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == jaccard_answer(rows)


def _near_copies() -> list[tuple]:
    """A crowd of near copies, chains at the threshold, and a passage that many others share."""
    draw = np.random.default_rng(3)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(60):  # copies with one or two words changed: many pairs of them are not similar
        words = list(base)
        for k in draw.integers(0, 120, 2):
            words[k] = f"x{i}-{k}"
        rows.append((i, " ".join(words)))
    for i in range(40):  # each shares most with the one before
        rows.append((100 + i, " ".join(f"c{k}" for k in range(6 * i, 6 * i + 100))))
    for i in range(60):  # a common passage, a fifth to a half of the text
        own = [f"p{i}-{k}" for k in range(int(draw.integers(40, 160)))]
        rows.append((200 + i, " ".join(own + [f"q{k}" for k in range(40)])))
    return rows + [(300, "One two three"), (301, "one TWO three"), (302, ""), (303, None), (304, "one two")]


def test_jaccard_join_of_crowds_and_chains(spark):
    rows = _near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == jaccard_answer(rows)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in got.values()}


def test_a_crowd_left_in_several_components_meets_its_hubs_first(spark, monkeypatch):
    """Copies that link with their source alone, which comes last: all pairs across them would be compared."""
    from brookledger.llm import jaccard_join

    rng = np.random.default_rng(3)
    source = [f"s{k}" for k in range(150)]
    rows = []
    for i in range(100):
        words = list(source)
        for k in rng.choice(np.arange(3) * 45, 3, replace=False) + rng.integers(5, 40):
            words[k] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    rows.append((100, " ".join(source)))
    counts, measured = [], jaccard_join._measured

    def counting(pairs, *others):
        counts.append(pairs.count())
        return measured(pairs, *others)

    monkeypatch.setattr(jaccard_join, "_measured", counting)
    monkeypatch.setattr(jaccard_join, "CROWDED", 4, raising=False)
    monkeypatch.setattr(jaccard_join, "HUBS", 2, raising=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == jaccard_answer(rows)
    assert {c for _, c in got.values()} == {0}
    assert sum(counts) < 1500, counts


def test_jaccard_join_of_awkward_rows(awkward, empty):
    got = jaccard_components(awkward).collect()
    assert len(got) == 16
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and by[7]["component_id"] == 6 and by[None]["component_id"] is None
    assert (by[3]["n_shingles"], by[3]["component_id"]) == (0, 3)
    kept = [r["doc_id"] for r in one_of_each_group(awkward).collect()]
    assert sorted((k or 0) for k in kept) == [0, 1, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14]
    assert jaccard_components(empty).count() == 0 and one_of_each_group(empty).count() == 0


# ---- embeddings -----------------------------------------------------------------
def _cosine_answer(rows, threshold=0.93):
    n, links = {}, []
    for i, v, label in rows:
        n[i] = 0
        links.append((i, i))
    for i, v, label in rows:
        for j, w, other in rows:
            if i != j and label is not None and label == other and v and w and len(v) == len(w) and None not in v + w:
                a, b = np.array(v), np.array(w)
                size = math.sqrt(a @ a) * math.sqrt(b @ b)
                if np.isfinite(size) and size > 0 and a @ b / size >= threshold:
                    n[i] += 1
                    links.append((i, j))
    component = groups(links)
    return {i: (n[i], component[i], component[i] == i) for i in n}


def _clustered(seed=1):
    draw = np.random.default_rng(seed)
    rows, centres = [], draw.normal(size=(30, 16))
    for i in range(500):
        c = centres[0] if i % 3 == 0 else centres[draw.integers(30)]
        rows.append((i, (c + draw.normal(size=16) * draw.choice([0.05, 0.25, 1.0])).tolist(), int(draw.integers(3))))
    return rows


def test_near_duplicate_vectors(spark):
    rows = _clustered()
    rows += [(900, rows[0][1], rows[0][2]), (901, [2 * x for x in rows[0][1]], rows[0][2]), (902, rows[0][1], None)]
    rows += [(903, None, 1), (904, [0.0] * 16, 1), (905, [None] + [1.0] * 15, 1), (906, [math.nan] + [1.0] * 15, 1), (907, [], 1), (908, [1.0, 2.0], 1), (909, [2.0, 4.0], 1)]
    vectors = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, node string, kept string").repartition(5)
    want = _cosine_answer(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(vectors).collect()}
    assert found == want


@pytest.mark.parametrize("directions", [1, 2])
def test_links_across_cuts_in_few_directions_count_for_both_ends(spark, directions):
    """Vectors of 64 dimensions that differ along one or two directions only, so that lists cut through dense stretches."""
    draw = np.random.default_rng(directions)
    angle = draw.random(1500) * 2 * np.pi
    x = np.zeros((1500, 64))
    if directions == 1:
        x[:, 0], x[:, 1] = np.cos(angle), np.sin(angle)
    else:
        tilt = draw.random(1500) * np.pi
        x[:, 0], x[:, 1], x[:, 2] = np.cos(angle) * np.sin(tilt), np.sin(angle) * np.sin(tilt), np.cos(tilt)
    x = x @ np.linalg.qr(draw.normal(size=(64, 64)))[0]
    cosine = x @ x.T
    assert (np.abs(cosine - 0.93) > 1e-12).all()
    n_links = (cosine >= 0.93).sum(axis=1) - 1
    vectors = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(vectors).collect()}
    component = groups([(int(a), int(b)) for a, b in zip(*np.nonzero(cosine >= 0.93))])
    assert found == {i: (n, component[i]) for i, n in enumerate(n_links.tolist())}


def test_near_duplicates_of_repeated_rows_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>, label string"
    rows = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (None, [1.0, 0.0], "a")]
    got = sorted(((r["vec_id"] or 0), r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(rows, kind)).collect())
    assert got == [(0, 0, None, False), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_coded_distances_are_within_the_error():
    x = np.random.default_rng(2).normal(size=(600, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = Index.fit(x, 8)
    which, codes, error = index.encode(x)
    for k in range(8):
        mine = np.flatnonzero(which == k)
        off = index.distances(x[:50], k, codes[mine]) - np.linalg.norm(x[:50, None] - x[mine], axis=2)
        assert (np.abs(off) <= error[mine] + 1e-9).all()
