"""Facts of a day by change sets: equal to a rebuild, and files that nothing touched are not read."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from brookledger import catalog
from brookledger.plans import fact_delta, gold, scd2
from brookledger.plans.silver import to_silver
from brookledger.sources import snapshots
from brookledger.sources.tables import stage, stage_all

DAY = dt.datetime(2024, 3, 1)
LATER = dt.datetime(2023, 6, 1)


def customer(k, **more):
    return {"customer_id": f"C{k}", "first_name": "Ann", "last_name": "Lee", "email": "a@b.c", "date_of_birth": "1990-01-01",
            "customer_since": "2015-01-01", "status": "active", "credit_score": "700", **more}


def account(k, **more):
    return {"account_id": f"A{k}", "customer_id": f"C{k}", "account_number": "****1", "account_type": "checking", "balance": "10.00",
            "available_balance": "10.00", "currency": "USD", "interest_rate": "0.01", "opened_date": "2015-01-01", "status": "active", "branch_code": "B1", **more}


def transaction(k, owner, **more):
    return {"transaction_id": f"T{k}", "account_id": f"A{owner}", "customer_id": f"C{owner}", "transaction_type": "deposit", "amount": "5.00", "currency": "USD",
            "balance_after": "10.00", "channel": "atm", "status": "completed", "transaction_date": "2023-05-01 10:00:00", "value_date": "2023-05-01",
            "reference_number": f"R{k}", **more}


def flag(k, of, owner, **more):
    return {"flag_id": f"F{k}", "transaction_id": f"T{of}", "account_id": f"A{owner}", "customer_id": f"C{owner}", "flag_reason": "r", "severity": "high",
            "fraud_score": "0.8", "is_confirmed_fraud": "False", "flagged_at": "2023-05-02 10:00:00", **more}


@pytest.fixture
def world(spark, raw, tmp_path):
    """40 customers with an account and 10 transactions each; every third account is not there yet; some flags."""
    first = {
        "customers": [customer(k) for k in range(40)],
        "accounts": [account(k) for k in range(40) if k % 3],
        "transactions": [transaction(k, k % 40) for k in range(400)],
        "fraud_flags": [flag(k, 7 * k, 7 * k % 40) for k in range(30)],
    }
    root = str(tmp_path / "facts")

    def silver_of(rows):
        return stage_all({e: to_silver(raw(e, *r), e, DAY) for e, r in rows.items()}, "silver")

    silver = silver_of(first)
    calendar = gold.dim_date(spark, DAY)
    dims = stage_all({
        "dim_accounts": gold.dim_accounts(silver["accounts"], DAY),
        "dim_customers": scd2.bootstrap(gold.dim_customers(silver["customers"], DAY), DAY)}, "dims")
    args = (dims["dim_accounts"], dims["dim_customers"], calendar, DAY)
    transactions = stage(gold.fact_transactions(silver["transactions"], silver["fraud_flags"], *args), "t")
    fraud = stage(gold.fact_fraud(silver["fraud_flags"], transactions, *args), "f")
    states = {n: fact_delta.create(spark, root, n, f, rows_per_file=15) for n, f in ((fact_delta.TRANSACTIONS, transactions), (fact_delta.FRAUD, fraud))}
    version = snapshots.commit(spark, root, snapshots.EMPTY, states)

    def day(following):
        """(run by changes, rebuild with lasting keys)"""
        both = {e: [*first[e], *({**r, "_load_timestamp": LATER} for r in following.get(e, []))] for e in first}
        second = silver_of(both)
        empty = {e: following.get(e) or [{}] for e in first}
        came = {e: to_silver(raw(e, *empty[e]), e, DAY) for e in ("transactions", "fraud_flags")}
        came = {e: df if following.get(e) else df.limit(0) for e, df in came.items()}
        after = stage_all({
            "dim_accounts": gold.dim_accounts(second["accounts"], DAY, dims["dim_accounts"]),
            "dim_customers": scd2.apply_history(dims["dim_customers"], second["customers"], DAY).dimension}, "after")
        found, facts = fact_delta.run_day(spark, root, came, second, dims, after, calendar, DAY, rows_per_file=15)
        known = (after["dim_accounts"], after["dim_customers"], calendar, DAY)
        whole = stage(gold.fact_transactions(second["transactions"], second["fraud_flags"], *known, transactions), "whole")
        rebuilt = {fact_delta.TRANSACTIONS: whole, fact_delta.FRAUD: gold.fact_fraud(second["fraud_flags"], whole, *known, fraud)}
        return found, facts, rebuilt

    return version, day


def check(spark, found, rebuilt):
    for name, whole in rebuilt.items():
        columns = sorted(whole.columns)
        assert rows_of(snapshots.read(spark, found, name).select(*columns)) == rows_of(whole.select(*columns))


def test_every_kind_of_change_equals_a_rebuild(spark, world):
    _, day = world
    found, _, rebuilt = day({
        "customers": [customer(5, status="inactive"), customer(50)],  # a new version, a new customer
        "accounts": [account(3), account(50), account(4, account_type=None, customer_id=None)],  # one appears, one may go
        "transactions": [
            transaction(11, 11, amount="9.00"), transaction(12, 30),  # changed, moved to another account
            transaction(13, 13, amount="n/a"),  # becomes invalid
            transaction(900, 50), transaction(901, 1)],
        "fraud_flags": [
            flag(0, 1, 1),  # names another transaction now
            flag(1, 7, 7, fraud_score=None), flag(80, 900, 50), flag(81, 20, 20), flag(82, 13, 13)],
    })
    check(spark, found, rebuilt)


def test_files_that_nothing_touched_stay(spark, world):
    before, day = world
    files = {n: set(snapshots.file_paths(spark, s)) for n, s in before.tables.items()}
    assert len(files[fact_delta.TRANSACTIONS]) > 20
    found, facts, rebuilt = day({"transactions": [transaction(11, 11, amount="9.00"), transaction(950, 11)], "fraud_flags": [flag(90, 11, 11)]})
    check(spark, found, rebuilt)
    for name, fact in facts.items():
        after = set(snapshots.file_paths(spark, found.tables[name]))
        assert files[name] - after == set(fact.rewritten) and len(fact.opened) <= 5
    assert len(facts[fact_delta.TRANSACTIONS].rewritten) == 1


def test_a_day_without_changes_keeps_every_file(spark, world):
    before, day = world
    found, facts, rebuilt = day({})
    assert all(f.rewritten == [] for f in facts.values())
    assert {n: s.manifest for n, s in found.tables.items()} == {n: s.manifest for n, s in before.tables.items()}
    check(spark, found, rebuilt)


def test_moved_pairs(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("n", None)], "id string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4), ("n", None)], "id string, v int")
    assert {tuple(r) for r in fact_delta.moved_pairs(before, after, "id", "v").collect()} == {("b", 5), ("c", None), ("d", 4)}


def test_a_day_that_touches_every_file_reads_them_once_for_that(spark, world, monkeypatch):
    """One column, not all columns of the index at once in as many joins."""
    read, columns = snapshots.read_files, []

    class Read:
        def __init__(self, rows):
            self.rows = rows

        def select(self, path, *names):
            columns.append(names)
            return self.rows.select(path, *names)

    before, _ = world
    state = before.tables[fact_delta.TRANSACTIONS]
    paths = snapshots.file_paths(spark, state)
    truth = read(spark, state, paths).select(F.col("_metadata.file_path").alias("path"), "transaction_id", "account_id").collect()
    monkeypatch.setattr(snapshots, "read_files", lambda *a: Read(read(*a)))
    every = spark.createDataFrame([(f"T{k}",) for k in range(400)] + [(None,)], "transaction_id string")
    some = spark.createDataFrame([("A1",), ("A2",), ("none",)], "account_id string")
    of = lambda column, *ids: {r.path for r in truth if r[column] in ids}
    assert fact_delta._holding(spark, state, paths, [("transaction_id", every), ("account_id", some)]) == sorted(paths)
    assert columns == [("transaction_id",)]
    one = every.where("transaction_id = 'T5'")
    assert fact_delta._holding(spark, state, paths, [("transaction_id", one), ("account_id", some)]) == sorted(of("transaction_id", "T5") | of("account_id", "A1", "A2"))
    assert columns[1:] == [("transaction_id",), ("account_id",)]
    assert fact_delta._holding(spark, state, [], [("transaction_id", every)]) == []


def test_the_query_stages_one_table_at_a_time(spark, monkeypatch):
    """Side by side, the driver would plan and compile for four tables at once."""
    staged = []

    class Enough(Exception):
        pass

    def last(*a, **k):
        raise Enough

    monkeypatch.setattr(catalog, "stage_all", last)
    monkeypatch.setattr(catalog, "SampleBronze", lambda *a: type("Tables", (), {"first": lambda self, e: e, "both": lambda self, e: e})())
    monkeypatch.setattr(catalog, "to_silver", lambda df, entity, as_of: entity)
    monkeypatch.setattr(catalog, "stage", lambda df, label: staged.append(df))
    monkeypatch.setattr(gold, "dim_date", lambda *a: None)
    monkeypatch.setattr(gold, "dim_accounts", last)
    with pytest.raises(Enough):
        catalog._facts_by_changes(spark, "nowhere")
    assert staged == ["customers", "accounts", "transactions", "fraud_flags", "accounts", "customers", "fraud_flags"]
