"""Each query against its DuckDB oracle on the smallest sample."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_oracle(spark, con, name):
    result = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert compare(result, oracle_sql()[name], con) == []
    else:
        assert result.count() > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_the_transaction_fact(spark):
    fact = entry(spark)
    assert fact.columns[:2] == ["transaction_key", "transaction_id"]
    assert fact.count() > 0
