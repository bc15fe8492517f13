from __future__ import annotations

import json

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from brookledger.plans import contracts, quality
from brookledger.plans.rule_catalogue import (
    BRONZE_RULES,
    GOLD_CHECKS,
    GOLD_RULES,
    SILVER_CHECKS,
    SILVER_RULES,
    Check,
    Measure,
)
from brookledger.plans.silver import to_silver


def test_catalogue_is_complete():
    ids = [r.rule_id for r in BRONZE_RULES + SILVER_RULES + GOLD_RULES]
    wanted = [f"{p}-{n:03d}" for p, top in (("BQ", 22), ("SQ", 27), ("GQ", 13)) for n in range(1, top + 1)]
    assert ids == wanted
    assert (len(SILVER_CHECKS), len(GOLD_CHECKS)) == (12, 7)


@pytest.mark.parametrize(
    ("expected", "value", "met"),
    [
        ("> 0", 1.0, True), ("> 0", 0.0, False), (">= 95", 95.0, True), ("= 2922", 2922.0, True),
        ("<= 3", 3.5, False), ("< 3", 2.0, True), ("!= 3", 2.0, False), ("= many", 2.0, False),
        ("", 2.0, False), ("= 0", None, False),
    ],
)
def test_comparators(spark, expected, value, met):
    number = "cast(NULL AS double)" if value is None else f"{value}D"
    row = spark.range(1).selectExpr(f"{quality.meets(number, expected)} AS m").first()
    assert row.m is met


def test_texts_are_quoted(spark):
    odd = "it's \\ odd"
    results = quality.run_suite(
        {"t": spark.range(1)}, [Check("c", odd, "SILVER", "t", "LOW", Measure("rows"), "> 0")], AS_OF
    )
    assert results.first().description == odd


def check(name, measure, expected, severity="HIGH", table="t"):
    return Check(name, "", "SILVER", table, severity, measure, expected)


def test_measures_and_missing_tables(spark):
    table = spark.createDataFrame(
        [("a", 1, True), ("a", 5, False), (None, None, True), (None, 9, False)],
        "k string, v int, ok boolean",
    )
    results = quality.run_suite(
        {"t": table, "u": table},
        [
            check("rows", Measure("rows"), "= 4"),
            check("range", Measure("breaches", "v < 2 or v > 8"), "= 2"),
            check("domain", Measure("breaches", "k not in ('b')"), "= 2"),
            check("share", Measure("percent", "ok"), "= 50"),
            check("repeats", Measure("repeats", column="k"), "= 2"),
            check("one", Measure("not_one", "ok", "k"), "= 0"),
            check("gone", Measure("rows"), "> 0", "CRITICAL", "nowhere"),
            check("column", Measure("breaches", "nope is null"), "= 0", "LOW", "u"),
        ],
        AS_OF,
    )
    got = {r.check_name: r for r in results.collect()}
    passed = {n for n, r in got.items() if r.status == "PASSED"}
    assert passed == {"rows", "range", "domain", "share", "repeats", "one"}
    assert got["gone"].error_message == "table nowhere not found"
    assert "nope" in got["column"].error_message
    summary = quality.summarize(quality.with_suite_name(results, "s")).first()
    assert (summary.total, summary.passed, summary.failed) == (8, 6, 2)
    assert (summary.pass_rate, summary.critical_failures) == (75.0, 1)
    with pytest.raises(quality.CriticalChecksFailed, match="gone"):
        quality.require_no_critical_failure(results)
    failed = {r.check_name: r.response_time for r in quality.with_escalation(results).collect()}
    assert failed == {"gone": "15 minutes", "column": "Next business day"}


def test_share_of_an_empty_table_fails_without_error(spark):
    empty = spark.createDataFrame([], "ok boolean")
    row = quality.run_suite({"t": empty}, [check("p", Measure("percent", "ok"), ">= 95")], AS_OF).first()
    assert (row.actual, row.status, row.error_message) == (None, "FAILED", "")


def test_clean_rows_pass_the_gate(raw):
    good = to_silver(
        raw("customers", {"customer_id": "C", "email": "a@b", "date_of_birth": "1990-01-01",
                          "status": "active", "credit_score": "700", "state": "ca"}),
        "customers", AS_OF,
    )
    own = [c for c in SILVER_CHECKS if c.table == "silver_customers"]
    results = quality.run_suite({"silver_customers": good}, own, AS_OF)
    assert {r.status for r in results.collect()} == {"PASSED"}
    quality.require_no_critical_failure(results)


def test_one_scan_per_table_for_all_row_rules(spark):
    path = "/root/testdata/sf0.001/orders.parquet"
    orders = spark.read.parquet(path)
    checks = [check(f"c{i}", Measure("breaches", f"o_totalprice < {i}"), "= 0") for i in range(6)]
    plan = quality.run_suite({"t": orders}, checks, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_report_is_one_json_document(spark, tmp_path):
    results = quality.run_suite({"t": spark.range(3)}, [check("n", Measure("rows"), "= 3")], AS_OF)
    path = quality.save_report(results, "silver_layer", AS_OF, str(tmp_path))
    assert path.endswith("dq_report_silver_layer_20240101_000000")
    (row,) = spark.read.text(path).collect()
    report = json.loads(row.value)
    assert report["summary"]["pass_rate"] == "100.0%"
    assert report["checks"][0]["actual"] == "3.0"


def test_orphans_count_rows_per_missing_value(spark, raw):
    def table(entity, *rows):
        return to_silver(raw(entity, *rows), entity, AS_OF)

    tables = {
        "customers": table("customers", {"customer_id": "C1"}),
        "accounts": table("accounts", {"account_id": "A1", "customer_id": "C1"},
                          {"account_id": "A2", "customer_id": None}),
        "transactions": table("transactions", *[
            {"transaction_id": f"T{i}", "account_id": "A9", "customer_id": "C1"} for i in range(3)]),
        "fraud_flags": table("fraud_flags", {"flag_id": "F", "transaction_id": "T0",
                                             "account_id": "A1", "customer_id": "C7"}),
    }
    got = {(r.child_table, r.foreign_key, r.missing_id, r.row_count) for r in quality.orphans(tables).collect()}
    assert got == {("transactions", "account_id", "A9", 3), ("fraud_flags", "customer_id", "C7", 1)}


CUSTOMER = {
    "customer_id": "C", "first_name": "A", "last_name": "B", "email": "A@B", "phone": "1",
    "date_of_birth": "1990-01-01", "address_line1": "x", "city": "y", "state": "CA",
    "zip_code": "1", "country": "US", "customer_since": "2020-01-01", "status": "ACTIVE",
    "credit_score": "700",
}


@pytest.mark.parametrize(
    ("change", "violations"),
    [
        ({}, ""), ({"first_name": ""}, "first_name"), ({"first_name": "x" * 51}, "first_name"),
        ({"state": "CAL", "email": "none"}, "email,state"), ({"status": "active"}, "status"),
        ({"status": None, "country": None}, ""), ({"credit_score": "299"}, "credit_score"),
        ({"credit_score": "700.5"}, "credit_score"), ({"date_of_birth": "soon"}, "date_of_birth"),
        ({"customer_id": None}, "customer_id"), ({"address_line2": "x" * 101}, "address_line2"),
    ],
)
def test_customer_contract(raw, change, violations):
    row = contracts.validate(raw("customers", {**CUSTOMER, **change}), "customers", AS_OF).first()
    assert (row.violations, row.is_valid) == (violations, violations == "")
    assert (row.status or "ACTIVE", row.country) == (change.get("status") or "ACTIVE", "US")
    assert row.email == row.email.lower()


def test_masking(spark):
    numbers = spark.createDataFrame([("1234567890",), ("****7890",), (None,)], "account_number string")
    rows = contracts.masked_accounts(numbers.withColumn("account_id", F.lit("A"))).collect()
    assert [r.account_number for r in rows] == ["****7890", "****7890", None]
    assert [r.was_masked for r in rows] == [False, True, None]


def test_a_check_that_breaks_while_running_fails_alone(spark):
    from brookledger.plans.quality import run_suite_apart
    from brookledger.plans.rule_catalogue import ROWS, Check, Measure

    table = spark.createDataFrame([("1",), ("x",)], "amount string")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    checks = [
        Check("rows", "", "SILVER", "t", "HIGH", ROWS, "> 0"),
        Check("broken", "", "SILVER", "t", "HIGH", Measure("breaches", predicate="cast(amount as int) > 0"), "= 0"),
        Check("absent", "", "SILVER", "no_such_table", "HIGH", ROWS, "> 0"),
    ]
    found = {r.check_name: r for r in run_suite_apart({"t": table}, checks, AS_OF).collect()}
    assert (found["rows"].status, found["rows"].actual) == ("PASSED", 2.0)
    assert found["broken"].status == "FAILED" and "CAST_INVALID_INPUT" in found["broken"].error_message
    assert found["absent"].status == "FAILED"
