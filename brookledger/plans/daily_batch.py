"""The daily batch: Bronze tables in, Silver, rejects, Gold and logs out."""

from __future__ import annotations

import contextlib
import datetime as dt
import posixpath
import uuid
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import SCD2_PIPELINE, SCD2_RUN_PREFIX
from brookledger.functions.calendar import compact_stamp
from brookledger.operators.dedup import latest_per_key, roll_forward
from brookledger.plans import audit, gold, quality, rejects, scd2
from brookledger.plans.rule_catalogue import GOLD_CHECKS, SILVER_CHECKS
from brookledger.plans.silver import clean_silver, to_silver
from brookledger.sources.tables import (
    publish,
    read_table,
    session_of,
    stage,
    staged_copies_removed,
    write_tables,
)


def store_silver(
    raw: Mapping[str, DataFrame], as_of: dt.datetime, root: str, loads: audit.Loads | None = None
) -> dict[str, DataFrame]:
    """Rebuild all Silver tables from all of Bronze and read them back."""
    spark, loads = session_of(raw), loads or audit.Loads()
    write_tables({e: _watched_silver(loads, to_silver(df, e, as_of), e) for e, df in raw.items()}, root)
    return {e: read_table(spark, root, e) for e in raw}


def _watched_silver(loads: audit.Loads, silver: DataFrame, entity: str) -> DataFrame:
    return loads.watched(silver, entity, F.col("dq_is_valid"))


def store_gold(
    silver: Mapping[str, DataFrame],
    as_of: dt.datetime,
    root: str,
    previous: Mapping[str, DataFrame] | None = None,
    loads: audit.Loads | None = None,
) -> dict[str, DataFrame]:
    """Build the star schema from stored Silver tables.

    Dimensions first, then the transaction fact, then the fraud fact, each
    from the stored tables of the step before. ``previous`` has the Gold tables
    before, whose members keep their keys; its ``dim_customers_history``, if
    there is one, is the customer dimension that facts are joined to.
    """
    spark, loads = session_of(silver), loads or audit.Loads()
    before = previous or {}

    def write(made: Mapping[str, DataFrame]) -> None:
        write_tables({n: loads.watched(df, n) for n, df in made.items()}, root)

    known_customers = before.get("dim_customers")
    if "dim_customers_history" in before:
        known_customers = gold.current_rows(before["dim_customers_history"])
    write(
        {
            "dim_date": gold.dim_date(spark, as_of).coalesce(1),
            "dim_customers": gold.dim_customers(silver["customers"], as_of, known_customers),
            "dim_accounts": gold.dim_accounts(silver["accounts"], as_of, before.get("dim_accounts")),
        }
    )
    tables = {n: read_table(spark, root, n) for n in ("dim_date", "dim_customers", "dim_accounts")}
    customers = before.get("dim_customers_history", tables["dim_customers"])
    dims = (tables["dim_accounts"], customers, tables["dim_date"])
    write(
        {
            "fact_transactions": gold.fact_transactions(
                silver["transactions"], silver["fraud_flags"], *dims, as_of,
                before.get("fact_transactions"),
            )
        }
    )
    tables["fact_transactions"] = read_table(spark, root, "fact_transactions")
    write(
        {
            "fact_fraud": gold.fact_fraud(
                silver["fraud_flags"], tables["fact_transactions"], *dims, as_of,
                before.get("fact_fraud"),
            )
        }
    )
    tables["fact_fraud"] = read_table(spark, root, "fact_fraud")
    return tables


def run_batch(
    spark: SparkSession, raw: Mapping[str, DataFrame], as_of: dt.datetime, root: str
) -> dict[str, DataFrame]:
    """One full rebuild of Silver and Gold under ``root``, which must be new.

    Rejects of the run and its log rows are written next to the tables; a run
    that fails leaves a FAILED row with the message.
    """
    with _run(spark, "BATCH", as_of, root):
        loads = audit.Loads()
        silver = store_silver(raw, as_of, posixpath.join(root, "silver"), loads)
        return _after_silver(spark, silver, as_of, root, loads)


@contextlib.contextmanager
def _run(spark: SparkSession, kind: str, as_of: dt.datetime, root: str) -> Iterator[None]:
    """What every run does: log its failure, and remove what it staged."""
    run_id = f"{kind}_{compact_stamp(as_of)}"
    log = posixpath.join(root, "run_log")
    with staged_copies_removed(spark), audit.failure_logged(
        spark, log, run_id=run_id, pipeline="daily_batch", entity="all", as_of=as_of
    ):
        yield


def store_latest(raw: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The newest Bronze row per key of each entity, to start increments from."""
    write_tables({e: latest_per_key(df, e) for e, df in raw.items()}, root)
    return {e: read_table(session_of(raw), root, e) for e in raw}


def run_increment(
    spark: SparkSession,
    latest: Mapping[str, DataFrame],
    batch: Mapping[str, DataFrame],
    as_of: dt.datetime,
    root: str,
    previous: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The state after one more batch, from the newest rows so far.

    Gives what ``run_batch`` gives over all of Bronze, except that members of
    ``previous``, the Gold tables before, keep their keys. Silver is projected from
    the newest rows without a further shuffle; it is projected whole, because
    ages and tenures move with the day. The new newest rows are returned as
    ``latest_*`` for the next run. Entities without a delivery stay as they are.
    """
    with _run(spark, "INCREMENT", as_of, root):
        rolled = {
            e: roll_forward(df, batch[e], e) if e in batch else df for e, df in latest.items()
        }
        latest_root = posixpath.join(root, "latest")
        write_tables(rolled, latest_root)
        stored = {e: read_table(spark, latest_root, e) for e in latest}
        silver_root = posixpath.join(root, "silver")
        loads = audit.Loads()
        write_tables(
            {e: _watched_silver(loads, clean_silver(df, e, as_of), e) for e, df in stored.items()}, silver_root)
        silver = {e: read_table(spark, silver_root, e) for e in latest}
        return {
            **_after_silver(spark, silver, as_of, root, loads, previous),
            **{f"latest_{e}": df for e, df in stored.items()},
        }


def _after_silver(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    as_of: dt.datetime,
    root: str,
    loads: audit.Loads,
    previous: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    write_tables({"reject_records": rejects.all_invalid_rows(silver, as_of)}, root)
    tables = store_gold(silver, as_of, posixpath.join(root, "gold"), previous, loads)
    log_rows = loads.log_rows(spark, silver, "SILVER", "bronze_to_silver", as_of).unionByName(
        loads.log_rows(spark, tables, "GOLD", "silver_to_gold", as_of)
    )
    audit.append(log_rows, posixpath.join(root, "run_log"))
    return {
        **{f"silver_{e}": df for e, df in silver.items()},
        **tables,
        "reject_records": read_table(spark, root, "reject_records"),
        "run_log": read_table(spark, root, "run_log"),
    }


def run_history(
    spark: SparkSession,
    table: tuple[str, str],
    silver_customers: DataFrame,
    as_of: dt.datetime,
    root: str,
) -> DataFrame:
    """Bring the customer dimension of a catalog table to the state of Silver.

    ``table`` is (database, name). The next state is written to a folder of
    its own under ``root`` and the name is moved there last; the summary of
    the run is returned and its log row appended to ``root``/run_log.
    """
    database, name = table
    log = posixpath.join(root, "run_log")
    with audit.failure_logged(
        spark, log, run_id=f"{SCD2_RUN_PREFIX}{compact_stamp(as_of)}", pipeline=SCD2_PIPELINE,
        entity="DIM_CUSTOMERS", as_of=as_of,
    ):
        dim = scd2.bootstrap(spark.table(f"`{database}`.`{name}`"), as_of)
        run = scd2.apply_history(dim, silver_customers, as_of)
        path = posixpath.join(root, f"{name}-{compact_stamp(as_of)}-{uuid.uuid4().hex[:8]}")
        run.dimension.write.parquet(path)
        audit.append(run.log_row, log)
        summary = stage(run.summary, "history-summary")
        publish(spark, database, name, path)
    return summary


def check_quality(
    silver: Mapping[str, DataFrame],
    gold_tables: Mapping[str, DataFrame],
    as_of: dt.datetime,
    folder: str,
) -> DataFrame:
    """Run both suites, save a report of each, and stop on a critical failure."""
    spark = session_of(silver)
    suites = {
        "silver_layer": ({f"silver_{e}": df for e, df in silver.items()}, SILVER_CHECKS),
        "gold_layer": (dict(gold_tables), GOLD_CHECKS),
    }
    measured = [
        quality.with_suite_name(
            quality.run_suite_apart(tables, checks, as_of, spark=spark), name
        )
        for name, (tables, checks) in suites.items()
    ]
    results = stage(reduce(DataFrame.unionByName, measured), "dq-results")
    for name in suites:
        own = results.filter(F.col("suite_name") == name).drop("suite_name")
        quality.save_report(own, name, as_of, folder)
    quality.require_no_critical_failure(results)
    return results
