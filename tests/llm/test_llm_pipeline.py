"""The pipeline stage by stage, and the registered queries."""

from __future__ import annotations

import pytest
from llm_cases import SF_DIR, jaccard_answer
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from brookledger.llm import language_id, queries
from brookledger.llm.mixing import mixture
from verification.compare import compare, connect


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{k}" for k in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), queries.ORACLES[name], connect(SF_DIR)) == []


def test_each_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = [(10_001, None, "en", "src1", 0), (10_002, "1 2 3", "en", "src1", 5), (10_003, docs.first()["text"] + " ", "en", None, 9)]
    before = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    columns = before.columns
    rows = {r["doc_id"]: r for r in before.collect()}

    def after(k, table):
        out = corpus_pipeline.written(corpus_pipeline.STAGES[k][1](spark, table, SF_DIR), "test")
        return out, out.collect()

    known, got = after(0, before)
    assert known.columns == columns and {r["doc_id"] for r in got} == set(rows) - {10_001, 10_002}

    exact, got = after(1, known)
    best: dict = {}
    for i, r in rows.items():
        if r["text"] and i != 10_002:
            key = "".join(r["text"].split())
            best[key] = min(best.get(key, (0, i)), (-len(r["text"]), i))
    assert exact.columns == columns and sorted(r["doc_id"] for r in got) == sorted(i for _, i in best.values())

    near, got = after(2, exact)
    answer = jaccard_answer([(i, rows[i]["text"]) for _, i in best.values()])
    assert near.columns == columns and sorted(r["doc_id"] for r in got) == sorted({c for _, c in answer.values()})

    plan = {r["doc_id"]: r["copies"] for r in mixture(near).collect()}
    mix, got = after(3, near)
    assert mix.columns == columns and sorted(r["doc_id"] for r in got) == sorted(i for i, n in plan.items() for _ in range(n))

    pieces, got = after(4, mix)
    assert len(got) == sum(plan.values()) and all(r["lossless"] for r in got)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]


def test_training_order_outlives_write_and_read(spark, tmp_path):
    """The mix is read back in another order than it was written in; positions still follow the training times."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mixed = corpus_pipeline.mixing_stage(spark, docs, SF_DIR)
    in_order = [r["doc_id"] for r in mixed.collect()]
    mixed.write.parquet(str(tmp_path / "mix"))
    stored = spark.read.parquet(str(tmp_path / "mix"))
    pieces = corpus_pipeline.encoding_stage(spark, stored, SF_DIR).collect()
    assert len({r["position"] for r in pieces}) == len(pieces)
    assert [r["doc_id"] for r in sorted(pieces, key=lambda r: r["position"])] == in_order
    times = {r["doc_id"]: r["times"] for r in mixture(docs).collect() if r["times"]}
    expected = [i for _, i in sorted((t, i) for i, ts in times.items() for t in ts)]
    assert in_order == expected
