"""Hand-made rows for each semantic decision of the Silver layer."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF, plan_of, rows_of

from brookledger.operators.dedup import (
    all_but_first,
    latest_per_key,
    roll_forward,
    superseded_rows,
)
from brookledger.plans.silver import to_silver

GOOD = {
    "customer_id": "C1", "first_name": "ann", "last_name": "lee", "email": "A@B.c",
    "date_of_birth": "2000-12-31", "status": "active", "credit_score": "700",
    "customer_since": "2023-12-31",
}


def one(df):
    (row,) = df.collect()
    return row


@pytest.mark.parametrize(
    ("text", "score", "tier"),
    [
        ("720.6", 721, "GOOD"), ("800", 800, "EXCEPTIONAL"), ("739", 739, "GOOD"),
        ("740", 740, "VERY_GOOD"), ("579", 579, "POOR"), ("bad", None, "POOR"),
        (None, None, "POOR"), ("99999999999", None, "EXCEPTIONAL"),
    ],
)
def test_scores_round_half_up_and_fall_to_poor(raw, text, score, tier):
    row = one(to_silver(raw("customers", {**GOOD, "credit_score": text}), "customers", AS_OF))
    assert (row.credit_score, row.credit_tier) == (score, tier)


def test_years_and_days_count_boundaries(raw):
    row = one(to_silver(raw("customers", GOOD), "customers", AS_OF))
    assert row.age_years == 24
    assert row.tenure_days == 1
    assert row.full_name == "Ann Lee"
    assert row.email == "a@b.c"
    assert row._silver_loaded_at == AS_OF


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("N/A", None), ("2023", None), ("2023-05-01 12:34:56", dt.date(2023, 5, 1)),
        ("2023-02-30", None), ("2023-05-01", dt.date(2023, 5, 1)), ("", None),
    ],
)
def test_only_iso_dates_are_read(raw, text, date):
    row = one(to_silver(raw("customers", {**GOOD, "date_of_birth": text}), "customers", AS_OF))
    assert row.date_of_birth == date
    assert row.dq_is_valid is (date is not None)


@pytest.mark.parametrize(
    ("text", "name"),
    [
        (" mary ANN ", "Mary Ann"), ("o'BRIEN-smith", "O'brien-Smith"), ("j.r. tolkien", "J.R. Tolkien"),
        ("nation_17", "Nation_17"), ("a\tb", "A\tB"), ("x/y (z)", "X/Y (Z)"), ("[q]\\w", "[Q]\\W"),
        ("", ""), (None, None),
    ],
)
def test_names_are_capitalised_after_every_word_break(raw, text, name):
    row = one(to_silver(raw("customers", {**GOOD, "first_name": text}), "customers", AS_OF))
    assert row.first_name == name


def test_blank_email_is_empty_and_valid(raw):
    row = one(to_silver(raw("customers", {**GOOD, "email": "  "}), "customers", AS_OF))
    assert (row.email, row.dq_is_valid, row.dq_issues) == ("", True, None)


def test_first_missing_column_names_the_issue(raw):
    row = one(
        to_silver(
            raw("customers", {**GOOD, "email": None, "status": None, "date_of_birth": "x"}),
            "customers", AS_OF,
        )
    )
    assert (row.dq_is_valid, row.dq_issues) == (False, "Missing or invalid email")


@pytest.mark.parametrize(
    ("text", "amount", "debit", "credit"),
    [
        ("-12.345", Decimal("-12.35"), True, False), (" 12.3 ", Decimal("12.30"), False, True),
        ("1,234.5", None, False, False), ("0", Decimal("0.00"), False, False),
        ("99999999999999999.99", None, False, False),
    ],
)
def test_amounts(raw, text, amount, debit, credit):
    row = one(
        to_silver(
            raw("transactions", {"transaction_id": "T", "account_id": "A", "amount": text,
                                 "transaction_date": "2023-05-01 23:59:59"}),
            "transactions", AS_OF,
        )
    )
    assert (row.amount, row.is_debit, row.is_credit) == (amount, debit, credit)
    assert row.amount_abs == (None if amount is None else abs(amount))
    assert row.transaction_date_key == 20230501


@pytest.mark.parametrize(
    ("flagged", "reviewed", "days"),
    [
        ("2023-05-01 23:59:00", "2023-05-02 00:01:00", 1),
        ("2023-12-30 10:00:00", None, 2),
        (None, None, None),
    ],
)
def test_days_to_review(raw, flagged, reviewed, days):
    flag = {"flag_id": "F", "transaction_id": "T", "fraud_score": "0.5", "severity": "odd",
            "flagged_at": flagged, "reviewed_at": reviewed, "is_confirmed_fraud": "yes"}
    row = one(to_silver(raw("fraud_flags", flag), "fraud_flags", AS_OF))
    assert (row.days_to_review, row.severity_rank, row.is_confirmed_fraud) == (days, 0, False)


def test_overdrawn_is_false_for_unknown_balance(raw):
    table = raw("accounts", {"account_id": "A", "balance": "x"}, {"account_id": "B", "balance": "-1"})
    got = {r.account_id: r.is_overdrawn for r in to_silver(table, "accounts", AS_OF).collect()}
    assert got == {"A": False, "B": True}


def test_key_is_compared_as_written_unless_normalized(raw):
    table = raw("customers", {**GOOD, "customer_id": " C1"}, {**GOOD, "customer_id": "C1"})
    assert to_silver(table, "customers", AS_OF).count() == 2
    assert to_silver(table, "customers", AS_OF, normalize_key=True).count() == 1


def test_newest_load_wins_then_file_then_columns(raw):
    late = dt.datetime(2023, 6, 1)
    table = raw(
        "customers",
        {**GOOD, "_load_timestamp": late, "_source_file": "a", "phone": "1"},
        {**GOOD, "_load_timestamp": late, "_source_file": "b", "phone": "2"},
        {**GOOD, "_load_timestamp": late, "_source_file": "b", "phone": "3"},
        {**GOOD, "_source_file": "z", "phone": "4"},
        {**GOOD, "customer_id": None, "phone": "5"},
        {**GOOD, "customer_id": None, "phone": "6"},
    )
    kept = {(r.customer_id, r.phone) for r in latest_per_key(table, "customers").collect()}
    assert kept == {("C1", "3"), (None, "6")}
    lost = [(r.customer_id, r.phone) for r in superseded_rows(table, "customers").collect()]
    assert sorted(lost, key=str) == [("C1", "1"), ("C1", "2"), ("C1", "4"), (None, "5")]


def test_missing_load_time_counts_as_newest(raw):
    table = raw("customers", {**GOOD, "_load_timestamp": None, "phone": "1"}, {**GOOD, "phone": "2"})
    assert one(latest_per_key(table, "customers")).phone == "1"


def test_dedup_limits_groups_before_the_shuffle(raw):
    plan = plan_of(latest_per_key(raw("customers", GOOD), "customers"))
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.index("row_number(), 1, Final") < physical.index("Exchange hashpartitioning")
    assert physical.index("Exchange hashpartitioning") < physical.index("row_number(), 1, Partial")


@pytest.mark.parametrize("max_batch_keys", [0, 100])
def test_roll_forward_equals_dedup_over_everything(raw, max_batch_keys):
    first = raw("customers", GOOD, {**GOOD, "customer_id": "C2"}, {**GOOD, "customer_id": None})
    later = raw(
        "customers",
        {**GOOD, "phone": "9", "_load_timestamp": dt.datetime(2023, 2, 1)},
        {**GOOD, "customer_id": "C3"},
        {**GOOD, "customer_id": None, "phone": "1"},
        {**GOOD, "customer_id": "C2", "_load_timestamp": dt.datetime(2020, 1, 1)},
    )
    whole = latest_per_key(first.unionByName(later), "customers")
    rolled = roll_forward(
        latest_per_key(first, "customers"), later, "customers", max_batch_keys=max_batch_keys
    )
    assert rows_of(rolled) == rows_of(whole)


def test_rows_a_small_batch_does_not_touch_are_not_shuffled(spark, raw):
    path = "/root/testdata/sf0.001/customer.parquet"
    stored = raw("customers", GOOD).limit(0).unionByName(
        spark.read.parquet(path).selectExpr("concat('K', c_custkey) AS customer_id"),
        allowMissingColumns=True,
    )
    rolled = roll_forward(stored, raw("customers", GOOD), "customers")
    plan = plan_of(rolled)
    untouched = plan[plan.index("== Physical Plan =="):].split("LeftAnti")[1].split("LeftSemi")[0]
    assert "FileScan parquet" in untouched
    assert "Window" not in untouched.split("FileScan parquet")[0]


def test_hot_key_is_split_and_stays_whole(spark):
    """A third of all rows share a key; many rows are exact copies."""
    rows = spark.range(30_000, numPartitions=12).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 9000)) AS k", "id % 50 AS v", "id"
    )
    got = all_but_first(rows, "k", "v DESC, id")
    pdf = rows.toPandas().sort_values(["k", "v", "id"], ascending=[True, False, True])
    expected = set(pdf[pdf.duplicated("k")].id)
    found = [r.id for r in got.select("id").collect()]
    assert len(found) == len(set(found)) == len(expected)
    assert set(found) == expected


def test_sizes_are_counted_without_a_single_task_limit(spark, raw):
    from conftest import plan_of

    from brookledger.sources.tables import broadcast_if_small

    table = spark.range(100).repartition(4)
    assert "SinglePartition" not in plan_of(broadcast_if_small(table, 1000))
    rolled = roll_forward(raw("customers", GOOD), raw("customers", GOOD), "customers")
    assert "GlobalLimit" not in plan_of(rolled)
