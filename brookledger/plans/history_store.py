"""Customer history in place: a day opens and rewrites only the files that hold its customers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.plans import scd2
from brookledger.plans.gold import valid_rows
from brookledger.sources import snapshots
from brookledger.sources.tables import stage

TABLE = "dim_customers"
#: Note with the largest surrogate key given so far, so that no run has to look for it.
LAST_KEY = "last_key"
#: Customers that the table's rows of one customer are told apart by.
_SPREAD = ("customer_key",)


@dataclass(frozen=True)
class HistoryDay:
    """What a day did: the version it published, its changes, and the files it looked into and replaced."""

    version: snapshots.Version
    changes: DataFrame
    summary: DataFrame
    opened: list[str]
    rewritten: list[str]


def start(spark: SparkSession, root: str, dim: DataFrame, *, rows_per_file: int = snapshots.ROWS_PER_FILE) -> snapshots.Version:
    """Store a bootstrapped dimension (a stored table) as the first version."""
    last = dim.agg(F.coalesce(F.max("customer_key"), F.lit(0))).first()[0]
    state = snapshots.create_table(
        spark, root, TABLE, dim, ["customer_id"], rows_per_file=rows_per_file, spread=_SPREAD, notes={LAST_KEY: last})
    return snapshots.commit(spark, root, snapshots.latest(spark, root), {TABLE: state})


def apply_day(
    spark: SparkSession, root: str, delivered: DataFrame, as_of: dt.datetime, *, rows_per_file: int = snapshots.ROWS_PER_FILE
) -> HistoryDay:
    """Bring the dimension up to the Silver rows of the day's customers.

    ``delivered`` has one row for each customer that came; those that did not
    come stay as they are. The file index names the files that may hold one of
    them, and only these are opened. Files with a CHANGED customer are written
    anew, with the ended and the new versions; files of customers that are
    UNCHANGED or not there at all stay. NEW customers come in files of their
    own. A second writer who publishes first makes this one fail (Conflict)
    without a trace; running the same day again changes nothing.
    """
    base = snapshots.latest(spark, root)
    state = base.tables[TABLE]
    rows = stage(delivered, "delivered-customers")
    manifest = snapshots.manifest_of(spark, state)
    holding = stage(snapshots.files_holding(manifest, "customer_id", valid_rows(rows).select("customer_id")), "files-holding")
    opened = [r[0] for r in holding.select("path").distinct().orderBy("path").collect()]
    known = snapshots.read_files(spark, state, opened)
    changes = stage(scd2.classify(known, rows), "history-changes")
    summary = scd2.run_summary(known, changes)

    touched = _holding_changed(known, changes) if opened else []
    before = snapshots.read_files(spark, state, touched)
    fresh = scd2.new_versions(known, changes, as_of, last_key=state.notes[LAST_KEY])
    added = stage(scd2.expire(before, changes, as_of).unionByName(fresh.select(*before.columns)), "history-rewritten")
    n_new = changes.where(F.col("change_type").isin("NEW", "CHANGED")).count()
    if not n_new:
        return HistoryDay(base, changes, summary, opened, [])
    grown = snapshots.replace_files(
        spark, root, TABLE, state, touched, added, rows_per_file=rows_per_file, spread=_SPREAD,
        notes={LAST_KEY: state.notes[LAST_KEY] + n_new})
    version = snapshots.commit(spark, root, base, {TABLE: grown})
    return HistoryDay(version, changes, summary, opened, touched)


def _holding_changed(known: DataFrame, changes: DataFrame) -> list[str]:
    """Files with a live version of a CHANGED customer."""
    changed = changes.where(F.col("change_type") == "CHANGED").select("customer_id")
    live = known.where("is_current").select(F.col("_metadata.file_path").alias("path"), "customer_id")
    held = live.join(changed, "customer_id", "left_semi").select("path").distinct().orderBy("path")
    return [r[0] for r in held.collect()]
