from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from brookledger.plans import daily_batch, gold, scd2
from brookledger.plans.silver import to_silver
from brookledger.sources.tables import publish, publish_bucketed, stage

DAY0, DAY1, DAY2 = (dt.datetime(2024, 5, d) for d in (1, 10, 20))
BASE = {"first_name": "a", "last_name": "b", "email": "x@y", "date_of_birth": "1990-01-01",
        "customer_since": "2020-01-01", "status": "active", "credit_score": "700",
        "city": "rome", "state": "ca"}


@pytest.fixture
def silver(raw):
    def make(*changes, as_of=DAY1):
        rows = [{**BASE, "customer_id": i, **change} for i, change in changes]
        return to_silver(raw("customers", *rows), "customers", as_of)

    return make


@pytest.fixture
def first(silver):
    table = stage(silver(("C1", {}), ("C2", {}), ("C3", {}), as_of=DAY0), "silver")
    return stage(scd2.bootstrap(gold.dim_customers(table, DAY0), DAY0), "dim")


def test_bootstrap_opens_every_row_and_is_stable(first):
    row = first.first()
    assert (row.effective_from, row.effective_to) == (dt.date(2024, 1, 1), dt.date(9999, 12, 31))
    assert row.is_current and len(row.record_hash) == 32
    assert rows_of(scd2.bootstrap(first, DAY2)) == rows_of(first)


def test_new_changed_unchanged_and_absent(spark, first, silver):
    run = scd2.apply_history(
        first, silver(("C1", {"status": "suspended"}), ("C2", {"email": "new@y"}), ("C9", {})), DAY1
    )
    kinds = {r.customer_id: r.change_type for r in run.changes.collect()}
    assert kinds == {"C1": "CHANGED", "C2": "UNCHANGED", "C9": "NEW"}
    summary = run.summary.first()
    assert (summary.rows_inserted, summary.rows_expired, summary.rows_unchanged) == (2, 1, 1)
    assert summary.message == "SCD2 Complete — Inserted: 2 | Expired: 1 | Unchanged: 1"
    dim = stage(run.dimension, "dim")
    versions = {(r.customer_id, r.is_current): r for r in dim.collect()}
    assert len(versions) == 5
    old, new = versions["C1", False], versions["C1", True]
    assert (old.effective_to, new.effective_from) == (dt.date(2024, 5, 9), dt.date(2024, 5, 10))
    assert {versions["C9", True].customer_key, new.customer_key} == {4, 5}
    assert versions["C3", True].effective_to == dt.date(9999, 12, 31)
    log = run.log_row.first()
    assert (log.run_id, log.records_loaded) == ("SCD2_20240510_000000", 2)

    counts = {r.record_type: r["count"] for r in scd2.version_counts(dim).collect()}
    assert counts == {"Current Records": 4, "Historical Records": 1, "Total Records": 5}


def test_same_batch_again_changes_nothing(first, silver):
    batch = silver(("C1", {"city": "oslo"}), ("C4", {}))
    dim = stage(scd2.apply_history(first, batch, DAY1).dimension, "dim")
    again = scd2.apply_history(dim, batch, DAY2)
    assert again.summary.first().rows_inserted == 0
    assert rows_of(again.dimension) == rows_of(dim)


def test_missing_stored_hash_counts_as_unchanged(first, silver):
    blank = first.withColumn("record_hash", F.lit(None).cast("string"))
    changes = scd2.classify(blank, silver(("C1", {"status": "inactive"})))
    assert [r.change_type for r in changes.collect()] == ["UNCHANGED"]


def test_second_change_on_one_day_leaves_an_empty_version(first, silver):
    one = stage(scd2.apply_history(first, silver(("C1", {"city": "oslo"})), DAY1).dimension, "dim")
    two = stage(scd2.apply_history(one, silver(("C1", {"city": "bern"})), DAY1).dimension, "dim")
    empty = two.filter("effective_to < effective_from").collect()
    assert [r.city for r in empty] == ["Oslo"]
    on_day = scd2.state_on(two, DAY1.date()).filter("customer_id = 'C1'").collect()
    assert [r.city for r in on_day] == ["Bern"]
    before = scd2.state_on(two, dt.date(2024, 5, 9)).filter("customer_id = 'C1'").collect()
    assert [r.city for r in before] == ["Rome"]


def test_state_at_the_time_of_a_fact(spark, first, silver):
    dim = stage(
        scd2.apply_history(first, silver(("C1", {"status": "suspended"})), DAY1).dimension, "dim"
    )
    fact = spark.createDataFrame(
        [(1, "C1", dt.datetime(2024, 5, 9, 23)), (2, "C1", dt.datetime(2024, 5, 10)),
         (3, "C1", dt.datetime(2023, 1, 1)), (4, "CX", DAY1), (5, None, DAY1)],
        "id int, customer_id string, at timestamp_ntz",
    )
    got = {r.id: r.status for r in scd2.with_state_at(fact, dim, "at", ["status"]).collect()}
    assert got == {1: "ACTIVE", 2: "SUSPENDED", 3: None, 4: None, 5: None}


def test_history_job_moves_readers_to_the_new_version(spark, first, silver, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swap_test LOCATION '{tmp_path}/db'")
    name = ("swap_test", "dim_customers")
    try:
        first.drop(*scd2.HISTORY_COLUMNS).write.parquet(str(tmp_path / "v1"))
        publish(spark, *name, str(tmp_path / "v1"))
        batch = stage(silver(("C1", {"city": "oslo"}), ("C2", {})), "silver")
        for day, inserted in ((DAY1, 1), (DAY2, 0)):
            summary = daily_batch.run_history(spark, name, batch, day, str(tmp_path))
            assert summary.first().rows_inserted == inserted
            assert spark.table("swap_test.dim_customers").count() == 4
        assert spark.read.parquet(str(tmp_path / "v1")).count() == 3
        assert spark.read.parquet(str(tmp_path / "run_log")).count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS swap_test CASCADE")


def test_bucketed_tables_are_compared_without_a_shuffle(spark, first, silver, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{tmp_path}/db'")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        batch = silver(("C1", {"city": "oslo"}), ("C2", {}))
        for name, df in (("dim", first), ("silver", batch)):
            publish_bucketed(df, "bucket_test", name, str(tmp_path / name), "customer_id", 4)
        changes = scd2.classify(spark.table("bucket_test.dim"), spark.table("bucket_test.silver"))
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert {r.customer_id: r.change_type for r in changes.collect()} == {
            "C1": "CHANGED", "C2": "UNCHANGED"}
    finally:
        spark.conf.set(threshold, before)
        spark.sql("DROP DATABASE IF EXISTS bucket_test CASCADE")
