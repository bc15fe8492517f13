"""Customer history: a new version of a member whenever a tracked value changes.

A parquet table has no row update, so a run builds the next state of the whole
dimension: finished versions pass through untouched, live versions are expired
where needed, new versions are appended. The classification is stored once and
feeds all of these and the run summary. Running the same batch again changes
nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookledger.fixed_values import (
    HASH_SEPARATOR,
    HISTORY_LISTING_ROWS,
    HISTORY_START,
    OPEN_END,
    SCD2_MESSAGE,
    SCD2_PIPELINE,
    SCD2_RUN_PREFIX,
    TRACKED_COLUMNS,
)
from brookledger.functions.bands import is_true
from brookledger.functions.calendar import compact_stamp, day, moment
from brookledger.operators.asof import with_state
from brookledger.operators.keys import with_dense_key
from brookledger.plans.audit import run_row
from brookledger.plans.gold import customer_attributes
from brookledger.sources.tables import add_missing_columns, stage

HISTORY_COLUMNS = ["effective_from", "effective_to", "is_current", "record_hash"]


def record_hash() -> Column:
    """MD5 of the tracked values; a missing value counts as empty text."""
    parts: list[Column] = []
    for name in TRACKED_COLUMNS:
        parts += [F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(HASH_SEPARATOR)]
    return F.md5(F.concat(*parts[:-1]))


def bootstrap(dim: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Give a dimension without history its first versions."""
    grown = add_missing_columns(
        dim,
        {
            "effective_from": (T.DateType(), as_of.date()),
            "effective_to": (T.DateType(), OPEN_END),
            "is_current": (T.BooleanType(), True),
            "record_hash": (T.StringType(), None),
        },
    )
    fresh = F.col("is_current").isNull() | F.col("record_hash").isNull()
    first_version = {
        "effective_from": F.lit(HISTORY_START),
        "effective_to": F.lit(OPEN_END),
        "is_current": F.lit(True),
        "record_hash": record_hash(),
    }
    return grown.select(
        *[c for c in grown.columns if c not in HISTORY_COLUMNS],
        *[
            F.when(fresh, value).otherwise(F.col(name)).alias(name)
            for name, value in first_version.items()
        ],
    )


def classify(dim: DataFrame, silver_customers: DataFrame) -> DataFrame:
    """Each valid Silver customer as NEW, CHANGED or UNCHANGED.

    A live version without a stored hash compares as unknown and therefore
    counts as UNCHANGED; ``bootstrap`` fills hashes in beforehand.
    """
    live = dim.filter(F.col("is_current")).select(
        "customer_id",
        F.col("record_hash").alias("old_hash"),
        F.col("customer_key").alias("existing_key"),
        F.lit(True).alias("_known"),
    )
    incoming = customer_attributes(silver_customers).withColumn("new_hash", record_hash())
    return incoming.join(live, "customer_id", "left").select(
        *incoming.columns,
        "old_hash",
        "existing_key",
        F.when(F.col("_known").isNull(), "NEW")
        .when(F.col("old_hash") != F.col("new_hash"), "CHANGED")
        .otherwise("UNCHANGED")
        .alias("change_type"),
    )


def _live_versions(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """Live versions with a mark on those that end now.

    History stays out of this join, so it sees one row per customer.
    """
    changed = (
        changes.filter(F.col("change_type") == "CHANGED")
        .select("customer_id")
        .distinct()
        .withColumn("_ends", F.lit(True))
    )
    return dim.filter(F.col("is_current")).join(changed, "customer_id", "left")


def expire(dim: DataFrame, changes: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Close the live version of every changed customer the day before the run."""
    live = _live_versions(dim, changes)
    ends = is_true(F.col("_ends"))
    closed = live.withColumns(
        {
            "effective_to": F.when(ends, F.date_sub(day(as_of), 1)).otherwise(
                F.col("effective_to")
            ),
            "is_current": ~ends,
        }
    ).select(*dim.columns)
    finished = dim.filter(~is_true(F.col("is_current")))
    return finished.unionByName(closed)


def new_versions(
    dim: DataFrame, changes: DataFrame, as_of: dt.datetime, last_key: int | None = None
) -> DataFrame:
    """Versions for NEW and CHANGED customers; keys go on after the largest.

    ``last_key`` is the largest key where that is known; ``dim`` is not read for it then.
    """
    rows = changes.filter(F.col("change_type").isin("NEW", "CHANGED"))
    numbered = with_dense_key(
        rows, "customer_key", "customer_id", tie_break=[F.col("email"), F.col("full_name")]
    )
    last = (
        dim.agg(F.coalesce(F.max("customer_key"), F.lit(0))).scalar()
        if last_key is None
        else F.lit(last_key)
    )
    return numbered.withColumns(
        {
            "customer_key": F.col("customer_key") + last,
            "_gold_loaded_at": moment(as_of),
            "effective_from": day(as_of),
            "effective_to": F.lit(OPEN_END),
            "is_current": F.lit(True),
            "record_hash": F.col("new_hash"),
        }
    ).select(*dim.columns)


def run_summary(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """One row: versions inserted, expired and left alone, and the message."""
    kind = F.col("change_type")
    counted = changes.agg(
        F.count_if(kind.isin("NEW", "CHANGED")).alias("rows_inserted"),
        F.count_if(kind == "UNCHANGED").alias("rows_unchanged"),
    )
    expired = _live_versions(dim, changes).agg(F.count("_ends"))
    with_expired = counted.withColumn("rows_expired", expired.scalar())
    return with_expired.select(
        "rows_inserted", "rows_expired", "rows_unchanged",
        F.format_string(
            SCD2_MESSAGE, "rows_inserted", "rows_expired", "rows_unchanged"
        ).alias("message"),
    )


def run_log_row(summary: DataFrame, as_of: dt.datetime) -> DataFrame:
    return run_row(
        summary,
        run_id=f"{SCD2_RUN_PREFIX}{compact_stamp(as_of)}",
        pipeline=SCD2_PIPELINE,
        entity="DIM_CUSTOMERS",
        started_at=as_of,
        loaded=F.col("rows_inserted"),
    )


@dataclass(frozen=True)
class HistoryRun:
    """What one run yields: the next dimension and how it came about."""

    dimension: DataFrame
    changes: DataFrame
    summary: DataFrame
    log_row: DataFrame


def apply_history(
    dim: DataFrame, silver_customers: DataFrame, as_of: dt.datetime
) -> HistoryRun:
    """Bring the dimension to the state of Silver. ``dim`` is a stored table.

    Write ``dimension`` to a new location and point readers there; the table
    it was read from must not be overwritten.
    """
    changes = stage(classify(dim, silver_customers), "history-changes")
    summary = run_summary(dim, changes)
    return HistoryRun(
        dimension=expire(dim, changes, as_of).unionByName(new_versions(dim, changes, as_of)),
        changes=changes,
        summary=summary,
        log_row=run_log_row(summary, as_of),
    )


def version_counts(dim: DataFrame) -> DataFrame:
    """Current, historical and total rows from one pass."""
    live = F.col("is_current")
    counted = dim.agg(
        F.count_if(live).alias("current"),
        F.count_if(~live).alias("historical"),
        F.count(F.lit(1)).alias("total"),
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("record_type"), F.col(name).alias("count"))
                    for label, name in (
                        ("Current Records", "current"),
                        ("Historical Records", "historical"),
                        ("Total Records", "total"),
                    )
                ]
            )
        )
    )


def history_sample(dim: DataFrame, rows: int = HISTORY_LISTING_ROWS) -> DataFrame:
    return (
        dim.select(
            "customer_id", "full_name", "status", "credit_score", "credit_tier", "city",
            "state", "effective_from", "effective_to", "is_current", "record_hash",
        )
        .orderBy("customer_id", "effective_from", "effective_to")
        .limit(rows)
    )


def state_on(dim: DataFrame, on: dt.date) -> DataFrame:
    """Every customer as it was on a day.

    A version replaced on the day it began covers no day and never shows.
    """
    return dim.filter((F.col("effective_from") <= F.lit(on)) & (F.col("effective_to") >= F.lit(on)))


def with_state_at(
    fact: DataFrame, dim: DataFrame, on: str, columns: list[str]
) -> DataFrame:
    """Customer columns as of each fact row's own day; none known leaves NULL.

    Versions and days of a customer are merged (``asof.with_state``), so a
    customer with very many facts and versions is not their product.
    """
    return with_state(
        fact, dim, key="customer_id", day=F.to_date(F.col(on)),
        since="effective_from", until="effective_to", columns=columns,
    )
