"""Facts of a day: only rows that one of the day's changes touches are computed again.

A fact is a join of its source rows with looked-up values: surrogate keys and
the fraud mark. It changes where a source row was delivered, or where a looked-up
value moved. Both are sets as small as the day. They find the files to open
through the fact's file index; there, delivered rows are built anew and other
rows get the moved values put in their place. Files without a touched row are
not read and stay part of the next version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.functions.calendar import moment
from brookledger.plans import gold
from brookledger.plans.gold import current_rows, valid_rows
from brookledger.sources import snapshots
from brookledger.sources.tables import stage

LAST_KEY = "last_key"
TRANSACTIONS, FRAUD = "fact_transactions", "fact_fraud"
_VALUE, _MOVED = "_value", "_moved"


@dataclass(frozen=True)
class Lookup:
    """A column of the fact that is looked up by an id, and the ids whose value moved: (id, value)."""

    id_column: str
    column: str
    moved: DataFrame


@dataclass(frozen=True)
class Fact:
    """How a fact's rows are told apart and numbered, and which ids its file index holds (the first lays it out)."""

    name: str
    id_column: str
    key_column: str
    indexed: tuple[str, ...]


FACTS = {
    TRANSACTIONS: Fact(TRANSACTIONS, "transaction_id", "transaction_key", ("account_id", "transaction_id", "customer_id")),
    FRAUD: Fact(FRAUD, "flag_id", "fraud_key", ("account_id", "flag_id", "transaction_id", "customer_id")),
}


@dataclass(frozen=True)
class FactChange:
    """A fact's next state, and the files it was looked for in and those replaced."""

    state: snapshots.TableState
    opened: list[str]
    rewritten: list[str]


def moved_pairs(before: DataFrame, after: DataFrame, id_column: str, value: str) -> DataFrame:
    """(id, value) of members whose value differs between two states; no value where a member is gone."""
    old = before.select(F.col(id_column).alias("_id"), F.col(value).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(id_column, F.col(value).alias(_VALUE), F.lit(True).alias("_is"))
    both = old.join(new, old["_id"] == new[id_column], "full")
    same = F.col("_old").eqNullSafe(F.col(_VALUE)) & F.col("_was").isNotNull() & F.col("_is").isNotNull()
    return both.where(~same).select(F.coalesce(id_column, "_id").alias(id_column), _VALUE)


def create(spark: SparkSession, root: str, name: str, fact: DataFrame, *, rows_per_file: int = snapshots.ROWS_PER_FILE) -> snapshots.TableState:
    """Store a fact (a stored table) as the first state of a versioned table."""
    shape = FACTS[name]
    last = fact.agg(F.coalesce(F.max(shape.key_column), F.lit(0))).first()[0]
    return snapshots.create_table(
        spark, root, name, fact, shape.indexed, rows_per_file=rows_per_file, spread=(shape.id_column,), notes={LAST_KEY: last})


def change(
    spark: SparkSession, root: str, name: str, state: snapshots.TableState, delivered: DataFrame, lookups: Sequence[Lookup],
    build: Callable[[DataFrame, int], DataFrame], as_of: dt.datetime, *, rows_per_file: int = snapshots.ROWS_PER_FILE,
) -> FactChange:
    """The fact after some source rows were delivered and some looked-up values moved.

    delivered: the ids that came, one column; their rows leave the fact and
    ``build(known, last_key)`` gives the new ones, where ``known`` has the keys
    that some of them had. Rows of other ids keep all but the moved values. Ids
    are unique in ``delivered`` and in each lookup's ``moved``.
    """
    shape = FACTS[name]
    manifest = snapshots.manifest_of(spark, state)
    came = stage(delivered.where(F.col(shape.id_column).isNotNull()).select(shape.id_column).distinct(), "delivered-ids")
    moved = [Lookup(x.id_column, x.column, stage(x.moved.where(F.col(x.id_column).isNotNull()), f"moved-{x.column}")) for x in lookups]
    sets = [(shape.id_column, came), *((x.id_column, x.moved.select(x.id_column)) for x in moved)]
    opened = snapshots.paths_holding(spark, manifest, sets)

    touched = _holding(spark, state, opened, sets)
    before = snapshots.read_files(spark, state, touched)
    last = int(state.notes[LAST_KEY])
    known = before.join(came, shape.id_column, "left_semi").select(shape.id_column, shape.key_column)
    rebuilt = stage(build(known, last), f"{name}-rebuilt")

    kept = before.join(came, shape.id_column, "left_anti").withColumn(_MOVED, F.lit(False))
    for x in moved:
        mark = f"_moved_{x.column}"
        put = x.moved.select(x.id_column, F.col(_VALUE), F.lit(True).alias(mark))
        kept = kept.join(put, x.id_column, "left").withColumns({
            x.column: F.when(F.col(mark), F.col(_VALUE)).otherwise(F.col(x.column)), _MOVED: F.col(_MOVED) | F.coalesce(mark, F.lit(False)),
        }).drop(_VALUE, mark)
    kept = kept.withColumn("_gold_loaded_at", F.when(F.col(_MOVED), moment(as_of)).otherwise(F.col("_gold_loaded_at"))).select(*before.columns)
    after = stage(kept.unionByName(rebuilt), f"{name}-rewritten")
    if not touched and after.isEmpty():
        return FactChange(state, opened, [])
    highest = rebuilt.agg(F.coalesce(F.max(shape.key_column), F.lit(0))).first()[0]
    grown = snapshots.replace_files(
        spark, root, name, state, touched, after, rows_per_file=rows_per_file, spread=(shape.id_column,), notes={LAST_KEY: max(last, highest)})
    return FactChange(grown, opened, touched)


def _holding(spark: SparkSession, state: snapshots.TableState, paths: Sequence[str], sets: Sequence[tuple[str, DataFrame]]) -> list[str]:
    """Those of the files that hold a value of any of the sets (column, one-column table of values), in order.

    Files that hold one of a set are not read for the next, so a day that
    touches every file reads one column of them once.
    """
    held: set[str] = set()
    for column, values in sets:
        if rest := [p for p in paths if p not in held]:
            ids = snapshots.read_files(spark, state, rest).select(F.col("_metadata.file_path").alias("path"), column)
            held |= {r[0] for r in ids.join(values, column, "left_semi").select("path").distinct().collect()}
    return sorted(held)


def run_day(
    spark: SparkSession, root: str, delivered: Mapping[str, DataFrame], silver: Mapping[str, DataFrame],
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], calendar: DataFrame, as_of: dt.datetime,
    *, rows_per_file: int = snapshots.ROWS_PER_FILE,
) -> tuple[snapshots.Version, dict[str, FactChange]]:
    """Bring both facts to a day's state and publish them as one version.

    delivered: Silver rows of the transactions and fraud flags that came, one
    row an id. silver: the flags after the delivery (of the transactions none
    but the delivered are needed). before, after: ``dim_accounts`` and
    ``dim_customers`` on both sides of the delivery. Gives what a rebuild with
    lasting keys gives, but for ``_gold_loaded_at`` of rows that nothing touched.
    """
    base = snapshots.latest(spark, root)
    accounts = moved_pairs(before["dim_accounts"], after["dim_accounts"], "account_id", "account_key")
    customers = moved_pairs(current_rows(before["dim_customers"]), current_rows(after["dim_customers"]), "customer_id", "customer_key")
    accounts, customers = stage(accounts, "moved-accounts"), stage(customers, "moved-customers")
    keys = [Lookup("account_id", "account_key", accounts), Lookup("customer_id", "customer_key", customers)]

    # Transactions of delivered flags, now or in the fact so far, with whether a valid flag names them today.
    flagged = valid_rows(silver["fraud_flags"]).select("transaction_id").distinct().withColumn("_flagged", F.lit(True))
    flags = stage(delivered["fraud_flags"], "delivered-flags")
    known_flags = base.tables[FRAUD]
    flag_files = snapshots.paths_holding(spark, snapshots.manifest_of(spark, known_flags), [("flag_id", flags.select("flag_id"))])
    earlier = snapshots.read_files(spark, known_flags, flag_files).join(flags.select("flag_id"), "flag_id", "left_semi").select("transaction_id")
    named = flags.select("transaction_id").unionAll(earlier).distinct()
    marks = named.join(flagged, "transaction_id", "left").select("transaction_id", F.coalesce("_flagged", F.lit(False)).alias(_VALUE))

    transactions = stage(delivered["transactions"], "delivered-transactions")
    of_these = valid_rows(silver["fraud_flags"]).join(transactions.select("transaction_id"), "transaction_id", "left_semi")
    dims = (after["dim_accounts"], after["dim_customers"], calendar)
    facts = {
        TRANSACTIONS: change(
            spark, root, TRANSACTIONS, base.tables[TRANSACTIONS], transactions, [*keys, Lookup("transaction_id", "is_fraud_flagged", marks)],
            lambda known, last: gold.fact_transactions(transactions, of_these, *dims, as_of, known, last), as_of, rows_per_file=rows_per_file)
    }

    # Keys that transactions got, or lost, today.
    state = facts[TRANSACTIONS].state
    manifest = snapshots.manifest_of(spark, state)
    asked = stage(transactions.select("transaction_id").unionAll(flags.select("transaction_id")).where("transaction_id IS NOT NULL").distinct(), "asked-transactions")
    holding = snapshots.paths_holding(spark, manifest, [("transaction_id", asked)])
    keyed = stage(snapshots.read_files(spark, state, holding).join(asked, "transaction_id", "left_semi").select("transaction_id", "transaction_key"), "asked-keys")
    numbered = transactions.select("transaction_id").distinct().join(keyed, "transaction_id", "left").select(
        "transaction_id", F.col("transaction_key").alias(_VALUE))
    facts[FRAUD] = change(
        spark, root, FRAUD, known_flags, flags, [*keys, Lookup("transaction_id", "transaction_key", numbered)],
        lambda known, last: gold.fact_fraud(flags, keyed, *dims, as_of, known, last), as_of, rows_per_file=rows_per_file)
    version = snapshots.commit(spark, root, base, {n: c.state for n, c in facts.items()})
    return version, facts
