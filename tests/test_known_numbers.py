"""Counts of the sample at scale 0.01 that were worked out beforehand."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from brookledger.fixed_values import ENTITIES
from brookledger.plans import daily_batch
from brookledger.plans.quality import CriticalChecksFailed
from brookledger.settings import DEFAULT_AS_OF
from brookledger.sources.sample_tables import SampleBronze

SF_DIR = "/root/testdata/sf0.01"
FAILING = {
    "silver_customers_no_null_ids": 1.0,
    "silver_transactions_no_null_amounts": 156.0,
    "silver_customers_no_null_emails": 42.0,
    "silver_customers_valid_status": 14.0,
    "silver_customers_valid_credit_score": 22.0,
    "silver_fraud_valid_score_range": 75.0,
    "silver_dq_pass_rate": 94.02,
    "gold_fact_txn_account_key_integrity": 407.0,
    "gold_fact_txn_customer_key_integrity": 1003.0,
}


def test_suites_and_gate(spark, tmp_path):
    sample = SampleBronze(spark, SF_DIR)
    silver = daily_batch.store_silver(
        {e: sample.both(e) for e in ENTITIES}, DEFAULT_AS_OF, str(tmp_path / "silver")
    )
    tables = daily_batch.store_gold(silver, DEFAULT_AS_OF, str(tmp_path / "gold"))
    with pytest.raises(CriticalChecksFailed) as stopped:
        daily_batch.check_quality(silver, tables, DEFAULT_AS_OF, str(tmp_path / "reports"))
    assert stopped.value.names == [
        "silver_customers_no_null_ids", "silver_dq_pass_rate", "silver_transactions_no_null_amounts",
    ]
    reports = spark.read.json(str(tmp_path / "reports" / "*"))
    checks = {c.check_name: c for r in reports.collect() for c in r.checks}
    assert len(checks) == 19
    failed = {n: float(c.actual) for n, c in checks.items() if c.status == "FAILED"}
    assert failed == FAILING

    # Rows that are clean pass the gate.
    clean = {e: df.filter("dq_is_valid") for e, df in silver.items()}
    results = daily_batch.check_quality(clean, tables, DEFAULT_AS_OF, str(tmp_path / "clean"))
    assert results.filter("severity = 'CRITICAL' and status = 'FAILED'").isEmpty()


def test_row_counts(spark):
    counts = {
        r.table_name: (r.row_count, r.valid_count)
        for r in queries()["silver_valid_counts"](spark, SF_DIR).collect()
    }
    assert counts == {
        "SILVER_CUSTOMERS": (1523, 1432), "SILVER_ACCOUNTS": (3043, 3000),
        "SILVER_TRANSACTIONS": (15040, 14637), "SILVER_FRAUD_FLAGS": (2185, 2067),
    }
