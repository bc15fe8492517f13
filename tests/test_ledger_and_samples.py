from __future__ import annotations

import random

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from brookledger.catalog import QUERIES
from brookledger.fixed_values import BUSINESS_KEY, ENTITIES
from brookledger.operators.dedup import latest_per_key
from brookledger.operators.ledger import balance_breaks
from brookledger.plans import contracts
from brookledger.sources.sample_tables import SampleBronze

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("chunk_size", [1, 3, 7, 1000])
def test_breaks_match_brute_force_with_one_hot_account(spark, chunk_size):
    rng = random.Random(5)
    entries, expected = [], set()
    for account, size in [("hot", 400), ("b", 30), ("c", 1), ("d", 2)]:
        shown = 0
        for n in range(size):
            amount = rng.randint(-9, 9)
            right = shown + amount
            shown = right + (1 if rng.random() < 0.1 else 0)
            if n > 0 and shown != right:
                expected.add((account, n))
            entries.append((account, n, n // chunk_size, amount, shown))
    rng.shuffle(entries)
    df = spark.createDataFrame(entries, "account string, seq int, page int, amount int, balance int")
    breaks = balance_breaks(
        df, account="account", order=["seq"], amount="amount", balance="balance", chunk="page"
    )
    assert {(r.account, r.seq) for r in breaks.collect()} == expected


@pytest.mark.parametrize("entity", ENTITIES)
def test_deliveries_hold_changes_repeats_ties_and_missing_keys(spark, entity):
    sample, key = SampleBronze(spark, SF_DIR), BUSINESS_KEY[entity]
    both = sample.both(entity)
    latest = latest_per_key(both, entity)
    assert sample.following(entity).count() > 0 and latest.count() < both.count()
    assert both.filter(F.col(key).isNull()).count() > 1
    ties = both.groupBy(key, "_batch_id").count().filter(f"{key} is not null and count > 1")
    assert ties.count() > 0
    assert sample.following(entity).join(sample.first(entity).select(key), key, "left_anti").count() > 0


@pytest.mark.parametrize("entity", ENTITIES)
def test_most_rows_meet_their_contract_and_each_rule_is_broken(spark, entity):
    rows = contracts.verdicts(SampleBronze(spark, SF_DIR).both(entity), entity, AS_OF)
    valid = rows.filter("is_valid").count()
    assert 2 * valid > rows.count()
    broken = {v for r in rows.select("violations").distinct().collect() for v in r.violations.split(",")}
    never = {"address_line1", "address_line2", "zip_code", "city", "phone", "created_at", "updated_at"} if entity == "customers" else set()
    assert {name for name, _ in contracts._CONTRACTS[entity]()} - broken <= never


def test_coded_rejects_hold_all_reason_codes(spark):
    codes = {r.reason_code for r in QUERIES["coded_rejects"](spark, SF_DIR).select("reason_code").distinct().collect()}
    assert codes == {
        "NULL_PK", "DUPLICATE_KEY", "REFERENTIAL_INTEGRITY", "INVALID_FORMAT", "INVALID_DOMAIN",
        "INVALID_DATE", "OUT_OF_RANGE", "ZERO_AMOUNT", "ARITHMETIC_FAILURE"}


def test_versions_before_and_after_the_second_delivery(spark):
    rows = QUERIES["scd2_as_of"](spark, SF_DIR)
    versions = {(str(r.as_of_day), r.is_current) for r in rows.select("as_of_day", "is_current").distinct().collect()}
    assert ("2025-06-29", False) in versions and ("2025-06-30", True) in versions
    assert rows.filter("as_of_day = date'2025-06-30' and effective_from = date'2025-06-30'").count() > 0
