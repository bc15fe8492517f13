"""Facts keep every valid row, whatever the shape of their keys."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import AS_OF, executed_plan_of

from brookledger.plans import daily_batch, gold
from brookledger.plans.silver import to_silver
from brookledger.sources.tables import stage_all

CUSTOMER = {"first_name": "a", "last_name": "b", "email": "x@y", "date_of_birth": "1990-01-01",
            "customer_since": "2020-01-01", "status": "active", "credit_score": "700"}


def test_calendar(spark):
    days = {r.full_date: r for r in gold.dim_date(spark, AS_OF).collect()}
    assert len(days) == 2922
    assert min(days) == dt.date(2020, 1, 1) and max(days) == dt.date(2027, 12, 31)
    sunday, leap = days[dt.date(2023, 1, 1)], days[dt.date(2024, 2, 29)]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sun", True)
    assert sunday.is_quarter_start and sunday.is_month_start and not sunday.is_weekday
    assert (leap.date_key, leap.is_month_end, leap.is_quarter_end) == (20240229, True, False)
    assert days[dt.date(2024, 3, 31)].is_quarter_end
    assert (leap.quarter_name, leap.month_name, leap.month_short) == ("Q1", "Feb", "Feb")


@pytest.mark.parametrize(
    ("column", "value", "band"),
    [
        ("tenure", 364, "0-1 Years"), ("tenure", 365, "1-2 Years"), ("tenure", 1825, "5-10 Years"),
        ("tenure", 3650, "10+ Years"), ("tenure", None, "10+ Years"),
        ("age", 17, "18-24"), ("age", 25, "25-34"), ("age", 64, "55-64"), ("age", None, "65+"),
    ],
)
def test_bands(spark, column, value, band):
    from pyspark.sql import functions as F

    from brookledger.fixed_values import AGE_BANDS_BELOW, DURATION_BANDS_BELOW
    from brookledger.functions.bands import band_below

    bands = AGE_BANDS_BELOW if column == "age" else DURATION_BANDS_BELOW
    row = spark.range(1).select(band_below(F.lit(value).cast("int"), bands).alias("b")).first()
    assert row.b == band


def _small_star(raw):
    tables = {
        "customers": raw("customers", {**CUSTOMER, "customer_id": "C1"},
                         {**CUSTOMER, "customer_id": "C2", "email": None}),
        "accounts": raw("accounts", {"account_id": "A1", "customer_id": "C1",
                                     "account_type": "gold", "status": "active"}),
        "transactions": raw(
            "transactions",
            *[{"transaction_id": f"T{i}", "account_id": a, "customer_id": c, "amount": "5",
               "transaction_date": d}
              for i, (a, c, d) in enumerate([
                  ("A1", "C1", "2023-01-01"), ("A9", "C2", "2023-01-01"),
                  ("A1", None, "1999-01-01"), ("A1", "C1", "bad"),
              ])],
        ),
        "fraud_flags": raw(
            "fraud_flags",
            {"flag_id": "F1", "transaction_id": "T0", "account_id": "A1", "customer_id": "C1",
             "fraud_score": "0.9", "flagged_at": "2023-01-02", "reviewed_at": "2023-01-05"},
            {"flag_id": "F2", "transaction_id": "T0", "account_id": "A1", "customer_id": "C1",
             "fraud_score": "0.69999", "flagged_at": "2023-01-02"},
            {"flag_id": "F3", "transaction_id": "T1", "fraud_score": None},
        ),
    }
    return {e: to_silver(df, e, AS_OF) for e, df in tables.items()}


def test_facts_keep_unmatched_rows_and_never_fan_out(spark, raw, tmp_path):
    silver = stage_all(_small_star(raw), "silver")
    tables = daily_batch.store_gold(silver, AS_OF, str(tmp_path / "gold"))
    facts = {r.transaction_id: r for r in tables["fact_transactions"].collect()}
    assert set(facts) == {"T0", "T1", "T2"}
    assert tables["fact_transactions"].count() == 3
    assert facts["T0"].account_key == 1 and facts["T0"].customer_key == 1
    assert facts["T1"].account_key is None and facts["T1"].customer_key is None
    assert facts["T2"].date_key is None and facts["T2"].customer_key is None
    assert [facts[t].is_fraud_flagged for t in ("T0", "T1", "T2")] == [True, False, False]
    fraud = {r.flag_id: r for r in tables["fact_fraud"].collect()}
    assert set(fraud) == {"F1", "F2"}
    assert (fraud["F1"].fraud_score_band, fraud["F1"].review_sla_met) == ("CRITICAL", True)
    assert (fraud["F2"].fraud_score_band, fraud["F2"].review_sla_met) == ("HIGH", False)
    assert fraud["F1"].transaction_key == facts["T0"].transaction_key
    assert tables["dim_accounts"].first().account_type_desc == "Unknown"


def test_dimension_with_history_is_joined_on_its_live_rows_only(spark):
    fact = spark.createDataFrame([("A", "C", 20230101)], "account_id string, customer_id string, _on_day int")
    accounts = spark.createDataFrame([("A", 1)], "account_id string, account_key long")
    customers = spark.createDataFrame(
        [("C", 1, False), ("C", 7, True)], "customer_id string, customer_key long, is_current boolean"
    )
    days = spark.createDataFrame([(20230101,)], "date_key int")
    rows = gold.with_dimension_keys(fact, accounts, customers, days).collect()
    assert [r.customer_key for r in rows] == [7]


def test_hot_account_is_split_by_the_skew_join(spark):
    """A third of the facts share an account; no dimension is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        fact = spark.range(200_000, numPartitions=8).selectExpr(
            "id", "if(id % 3 = 0, 'HOT', concat('A', id % 5000)) AS account_id",
            "concat('C', id % 5000) AS customer_id", "20230101 AS _on_day",
        )
        accounts = spark.range(5000).selectExpr(
            "if(id = 0, 'HOT', concat('A', id)) AS account_id", "id AS account_key"
        )
        customers = spark.range(5000).selectExpr(
            "concat('C', id) AS customer_id", "id AS customer_key"
        )
        days = spark.createDataFrame([(20230101,)], "date_key int")
        joined = gold.with_dimension_keys(fact, accounts, customers, days)
        plan = executed_plan_of(joined)
        assert "skew=true" in plan
        assert joined.count() == 200_000
        assert joined.filter("account_key = 0").count() == sum(1 for i in range(200_000) if i % 3 == 0)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_batch_run_invariants(spark, tmp_path):
    from brookledger.fixed_values import ENTITIES
    from brookledger.settings import DEFAULT_AS_OF
    from brookledger.sources.sample_tables import SampleBronze

    sample = SampleBronze(spark, "/root/testdata/sf0.001")
    raw_tables = {e: sample.both(e) for e in ENTITIES}
    out = daily_batch.run_batch(spark, raw_tables, DEFAULT_AS_OF, str(tmp_path / "lake"))
    for entity in ENTITIES:
        from brookledger.operators.dedup import superseded_rows

        kept, lost = out[f"silver_{entity}"].count(), superseded_rows(raw_tables[entity], entity).count()
        assert kept + lost == raw_tables[entity].count()
    valid = {e: out[f"silver_{e}"].filter("dq_is_valid").count() for e in ENTITIES}
    assert out["dim_customers"].count() == valid["customers"]
    assert out["dim_accounts"].count() == valid["accounts"]
    assert out["fact_transactions"].count() == valid["transactions"]
    assert out["fact_fraud"].count() == valid["fraud_flags"]
    rejected = sum(out[f"silver_{e}"].filter("not dq_is_valid").count() for e in ENTITIES)
    assert out["reject_records"].count() == rejected
    logged = {r.entity: r.records_loaded for r in out["run_log"].collect()}
    assert len(logged) == len(ENTITIES) + 5
    assert logged["fact_fraud"] == logged["fraud_flags"] == valid["fraud_flags"]
    for table, key in (("dim_customers", "customer_key"), ("fact_transactions", "transaction_key")):
        row = out[table].selectExpr(f"count(distinct {key}) n", f"min({key}) a", f"max({key}) z").first()
        assert (row.a, row.z) == (1, row.n) and row.n == out[table].count()


def test_increment_equals_full_rebuild(spark, tmp_path):
    from brookledger.fixed_values import ENTITIES
    from brookledger.settings import DEFAULT_AS_OF
    from brookledger.sources.sample_tables import SampleBronze

    sample = SampleBronze(spark, "/root/testdata/sf0.001")
    whole = daily_batch.run_batch(
        spark, {e: sample.both(e) for e in ENTITIES}, DEFAULT_AS_OF, str(tmp_path / "whole")
    )
    latest = daily_batch.store_latest(
        {e: sample.first(e) for e in ENTITIES}, str(tmp_path / "latest")
    )
    batch = {e: sample.following(e) for e in ENTITIES}
    step = daily_batch.run_increment(spark, latest, batch, DEFAULT_AS_OF, str(tmp_path / "step"))
    for name in whole:
        assert step[name].exceptAll(whole[name]).isEmpty(), name
        assert whole[name].count() == step[name].count()


def test_fact_scan_reads_only_what_it_needs(spark, raw):
    silver = stage_all(_small_star(raw), "silver")
    keys = gold.transaction_keys(silver["transactions"])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dq_is_valid), EqualTo(dq_is_valid,true)]" in plan
    assert "merchant_name" not in plan


def _exchanges(df):
    """Shuffles of the plan by the columns they carry, before adaptive changes."""
    plan = df._jdf.queryExecution().executedPlan()
    return [line for line in plan.toString().split("\n") if "Exchange hashpartitioning" in line]


def test_the_fact_moves_wide_rows_three_times(spark):
    from brookledger.fixed_values import ENTITIES
    from brookledger.settings import DEFAULT_AS_OF
    from brookledger.sources.sample_tables import SampleBronze

    sample = SampleBronze(spark, "/root/testdata/sf0.001")
    raw_tables = {e: sample.both(e) for e in ENTITIES}
    stored = stage_all({e: to_silver(df, e, DEFAULT_AS_OF) for e, df in raw_tables.items()}, "silver")
    accounts = gold.dim_accounts(stored["accounts"], DEFAULT_AS_OF)
    customers = gold.dim_customers(stored["customers"], DEFAULT_AS_OF)
    dims = stage_all({"accounts": accounts, "customers": customers}, "dims")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_transactions(
            stored["transactions"], stored["fraud_flags"], dims["accounts"], dims["customers"],
            gold.dim_date(spark, DEFAULT_AS_OF), DEFAULT_AS_OF,
        )
        by = [e.split("hashpartitioning(")[1] for e in _exchanges(fact)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The fact and its narrow partner, by account and by customer, and by bucket once for the
    # rows, once for the bucket sizes and once for the flags (which are made distinct before).
    count = {k: sum(e.startswith(k) for e in by) for k in ("account_id", "customer_id", "_key_bucket", "transaction_id")}
    assert count["account_id"] == 2 and count["customer_id"] == 2 and count["_key_bucket"] <= 3
    assert count["transaction_id"] <= 1


def test_keys_last_over_deliveries(spark):
    from brookledger.catalog import QUERIES, _history
    from brookledger.operators.keys import with_lasting_key

    known = spark.createDataFrame([("b", 7), ("a", 3)], "id string, k long")
    rows = spark.createDataFrame([("a", 1), ("c", 2), ("b", 3), (None, 4)], "id string, v int")
    found = {r.id: r.k for r in with_lasting_key(rows, "k", "id", known).collect()}
    assert found["a"] == 3 and found["b"] == 7 and {found["c"], found[None]} == {8, 9}

    sf = "/root/testdata/sf0.001"
    history = _history(spark, sf)[1].dimension.filter("is_current").select("customer_id", "customer_key")
    silver = QUERIES["silver_transactions"](spark, sf).filter("dq_is_valid").select("transaction_id", "customer_id")
    fact = QUERIES["fact_transactions_over_history"](spark, sf).drop("account_key").join(silver, "transaction_id")
    wrong = fact.join(history.withColumnRenamed("customer_key", "want"), "customer_id", "left").filter("not customer_key <=> want")
    assert wrong.count() == 0


def test_a_run_that_fails_is_logged(spark, tmp_path):
    from brookledger.settings import DEFAULT_AS_OF

    broken = {"customers": spark.range(1)}
    with pytest.raises(Exception):
        daily_batch.run_batch(spark, broken, DEFAULT_AS_OF, str(tmp_path / "lake"))
    (row,) = spark.read.parquet(str(tmp_path / "lake" / "run_log")).collect()
    assert row.status == "FAILED" and row.error_message and row.pipeline_name == "daily_batch"


def test_staged_copies_are_removed(spark):
    from pathlib import Path

    from brookledger.sources.tables import shared_folder, stage, staged_copies_removed

    folder = Path(shared_folder(spark))
    before = set(folder.glob("*")) if folder.exists() else set()
    with staged_copies_removed(spark):
        stage(spark.range(3), "one")
    assert set(folder.glob("*")) <= before
