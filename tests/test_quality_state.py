"""Suites from stored state equal suites over whole tables, and read only what a day touches."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from brookledger.operators.dedup import latest_per_key
from brookledger.plans import quality, quality_state
from brookledger.plans.rule_catalogue import SILVER_CHECKS, Check, Measure
from brookledger.plans.silver import clean_silver
from brookledger.sources import snapshots

DAY = dt.datetime(2024, 3, 1)
SCHEMA = "id string, grp string, amount int, live boolean"


def check(name, kind, predicate="", column="", expected="= 0", table="t"):
    return Check(name, "", "silver", table, "CRITICAL", Measure(kind, predicate, column), expected)


ITEMS = [
    check("rows", "rows", expected="> 2"),
    check("negative", "breaches", "amount < 0"),
    check("share", "percent", "amount IS NULL", expected="<= 5"),
    check("unique", "repeats", column="id"),
    check("one_live", "not_one", "live", "grp"),
]
FIRST = [("a", "x", 1, True), ("b", "x", -2, False), ("b", "y", None, True), (None, "y", 3, True), (None, None, 4, None)]


def state_of(spark, tmp_path, rows, **options):
    root = str(tmp_path / "state")
    return root, quality_state.start(spark, root, {"t": spark.createDataFrame(rows, SCHEMA)}, ITEMS, **options)


def full(spark, rows):
    return rows_of(quality.run_suite({"t": spark.createDataFrame(rows, SCHEMA)}, ITEMS, DAY))


def test_a_started_state_gives_the_full_suite(spark, tmp_path):
    _, version = state_of(spark, tmp_path, FIRST)
    assert rows_of(quality_state.suite(spark, version, ITEMS, DAY)) == full(spark, FIRST)


@pytest.mark.parametrize("gone, came", [
    ([1], [("b", "x", 5, True), ("c", "z", -1, False)]),
    ([3], []),
    ([0, 1, 2, 3, 4], []),
    ([], [("a", "x", None, None)] * 3),
    ([], []),
])
def test_days_carry_the_state(spark, tmp_path, gone, came):
    root, first = state_of(spark, tmp_path, FIRST)
    left = [r for n, r in enumerate(FIRST) if n not in gone]
    frames = ({"t": spark.createDataFrame(rows, SCHEMA)} for rows in ([FIRST[n] for n in gone], came))
    version = quality_state.advance(spark, root, *frames, ITEMS)
    assert rows_of(quality_state.suite(spark, version, ITEMS, DAY)) == full(spark, left + came)
    # The state before is still there for its readers.
    assert rows_of(quality_state.suite(spark, first, ITEMS, DAY)) == full(spark, FIRST)


def test_an_empty_table_and_a_missing_one(spark, tmp_path):
    _, version = state_of(spark, tmp_path, [])
    assert rows_of(quality_state.suite(spark, version, ITEMS, DAY)) == full(spark, [])
    other = [check("rows", "rows", table="not_there", expected="> 0")]
    row = quality_state.suite(spark, version, other, DAY).first()
    assert (row.status, row.actual, row.error_message) == ("FAILED", None, "table not_there not found")


def test_rows_that_were_never_counted_cannot_go(spark, tmp_path):
    root, version = state_of(spark, tmp_path, FIRST)
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(quality_state.StateMismatch):
        quality_state.advance(spark, root, {"t": spark.createDataFrame([("q", "x", 1, True)], SCHEMA)}, {"t": empty}, ITEMS)
    assert snapshots.latest(spark, root) == version


def test_files_without_a_value_of_the_day_stay(spark, tmp_path):
    rows = [(f"k{n}", f"g{n}", n, True) for n in range(400)]
    root, before = state_of(spark, tmp_path, rows, rows_per_file=40)
    empty = spark.createDataFrame([], SCHEMA)
    after = quality_state.advance(
        spark, root, {"t": empty}, {"t": spark.createDataFrame([("k7", "g7", 7, True)], SCHEMA)}, ITEMS, rows_per_file=40)
    old, new = (set(snapshots.file_paths(spark, v.tables[quality_state.TABLE])) for v in (before, after))
    assert len(old) == 20 and len(old - new) <= 4
    results = {r.check_name: r.actual for r in quality_state.suite(spark, after, ITEMS, DAY).collect()}
    assert results == {"rows": 401.0, "negative": 0.0, "share": 0.0, "unique": 1.0, "one_live": 1.0}


def test_a_silver_day_from_its_batch(spark, raw, tmp_path):
    first = raw("accounts", *[
        {"account_id": a, "customer_id": "C1", "balance": b} for a, b in (("A1", "1"), ("A2", "-5"), (None, "2"), ("A4", "x"))])
    late = dict(_load_timestamp=dt.datetime(2023, 1, 2))
    batch = raw("accounts", *[
        {"account_id": a, "customer_id": c, "balance": b, **late} for a, c, b in (("A2", "C1", "7"), (None, None, "3"), ("A9", "C2", "1"))])
    items = [i for i in SILVER_CHECKS if i.table == "silver_accounts"]
    latest = latest_per_key(first, "accounts")
    root = str(tmp_path / "state")
    quality_state.start(spark, root, {"silver_accounts": clean_silver(latest, "accounts", DAY)}, items)
    gone, came = quality_state.day_changes(latest, batch, "accounts", DAY)
    assert (gone.count(), came.count()) == (2, 3)
    version = quality_state.advance(spark, root, {"silver_accounts": gone}, {"silver_accounts": came}, items)
    whole = clean_silver(latest_per_key(first.unionByName(batch), "accounts"), "accounts", DAY)
    assert items and rows_of(quality_state.suite(spark, version, items, DAY)) == rows_of(
        quality.run_suite({"silver_accounts": whole}, items, DAY))
    assert whole.where(F.col("account_id").isNull()).count() == 1
