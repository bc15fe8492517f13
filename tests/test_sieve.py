from __future__ import annotations

import random

import pytest
from conftest import executed_plan_of
from pyspark.sql import functions as F

from brookledger.operators.sieve import may_match
from brookledger.plans import quality


@pytest.mark.parametrize("n", [0, 1, 50, 9_000])
def test_no_match_is_lost_and_few_others_stay(spark, n):
    small = spark.range(n).select(F.concat(F.lit("k"), F.col("id") * 7).alias("k"))
    large = spark.range(63_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("_sieve_key"))
    found = {r.id for r in may_match(large, "id", small, "k").collect()}
    right = {f"k{7 * k}" for k in range(n)}
    assert right <= found and len(found - right) < 0.03 * 63_000


def test_null_keys_repeated_keys_and_other_types(spark):
    small = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    large = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id long, v string")
    assert sorted(r.v for r in may_match(large, "id", small, "k").collect()) == ["a", "b"]


def test_a_filter_above_its_bound_is_not_made(spark):
    large, small = spark.range(10), spark.range(7_000)
    assert may_match(large, "id", small, "id", max_bytes=4096) is large


def _shuffled_rows(df) -> list[int]:
    """Records written by each exchange of the executed plan."""
    df.collect()
    out = []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if name == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "QueryStage" in name:
            return visit(node.plan())
        children = node.children()
        for k in range(children.size()):
            visit(children.apply(k))

    visit(df._jdf.queryExecution().executedPlan())
    return out


def _tables(spark):
    """20,000 transactions, 300 flags; some references of each kind are wrong."""
    rng = random.Random(3)
    ids = lambda p, n: [f"{p}{k}" for k in range(n)]
    pick = lambda p, n: None if rng.random() < 0.05 else f"{p}{rng.randrange(n)}"
    rows = {
        "customers": [(c,) for c in ids("C", 90)],
        "accounts": [(a, pick("C", 100)) for a in ids("A", 150)],
        "transactions": [(t, "A1" if k % 3 else pick("A", 160), pick("C", 100)) for k, t in enumerate(ids("T", 20_000))],
        "fraud_flags": [(f, pick("T", 21_000), pick("A", 160), pick("C", 100)) for f in ids("F", 300)],
    }
    columns = {
        "customers": ["customer_id"], "accounts": ["account_id", "customer_id"], "transactions": ["transaction_id", "account_id", "customer_id"],
        "fraud_flags": ["flag_id", "transaction_id", "account_id", "customer_id"],
    }
    return rows, columns, {e: spark.createDataFrame(rows[e], ", ".join(f"{c} string" for c in columns[e])) for e in rows}


def test_orphans_against_plain_python_and_what_is_shuffled(spark):
    rows, columns, tables = _tables(spark)
    parents = {e: {r[0] for r in rows[e]} for e in rows}
    want: dict = {}
    for child, column, parent in quality.REFERENCES:
        for r in rows[child]:
            value = r[columns[child].index(column)]
            if value is not None and value not in parents[parent]:
                want[child, column, parent, value] = want.get((child, column, parent, value), 0) + 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = quality.orphans(tables)
        got = {(r.child_table, r.foreign_key, r.parent_table, r.missing_id): r.row_count for r in found.collect()}
        moved = _shuffled_rows(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want
    # Parents: 240 customers and accounts, and of 20,000 transactions the flagged ones and a few by chance.
    assert moved and max(moved) < 6_000 and sum(moved) < 12_000
    assert executed_plan_of(found).count("left_semi") <= 1
