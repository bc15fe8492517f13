"""Suites from stored state: sums of a rule and counts of a key, carried from day to day.

The state of a suite is what its results are made of: for each row rule the
rows seen and the rows that match it, and for each uniqueness rule the rows of
each value. All of them are sums, so a day's rows are added and the rows that
they replace are taken away; the rest of a table is not read. Counts by value
are a versioned table, of which a day rewrites only the files that hold one of
its values; the sums, a few numbers, are notes of the version. Both are
published by one commit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import BUSINESS_KEY
from brookledger.operators.dedup import latest_per_key
from brookledger.plans.quality import Item, _not_measured, _unfold
from brookledger.plans.silver import clean_silver
from brookledger.sources import snapshots
from brookledger.sources.tables import broadcast_if_small, stage

TABLE = "dq_counts"
GROUPED = ("repeats", "not_one")
#: State by value: which rule's values, the value's own key, its rows, and those that match the rule.
COUNTS = "slot string, place string, rows long, hits long"
#: Keys of a batch that are broadcast to find the rows that it replaces.
MAX_BATCH_KEYS = 2_000_000
_WEIGHT = "_weight"


class StateMismatch(ValueError):
    """Rows were taken away that the state never counted."""


def start(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], items: Sequence[Item],
    *, rows_per_file: int = snapshots.ROWS_PER_FILE,
) -> snapshots.Version:
    """Count all rows of all tables once and publish that as the first state."""
    weighed = {name: df.withColumn(_WEIGHT, F.lit(1)) for name, df in tables.items()}
    totals = {name: _totals(df, _of(items, name)) for name, df in weighed.items()}
    counts = stage(_counts(spark, weighed, items), "dq-counts")
    notes = {"totals": totals, "wrong": _wrong(counts, items)}
    state = snapshots.create_table(spark, root, TABLE, counts, ["place"], rows_per_file=rows_per_file, notes=notes)
    return snapshots.commit(spark, root, snapshots.latest(spark, root), {TABLE: state})


def advance(
    spark: SparkSession, root: str, gone: Mapping[str, DataFrame], came: Mapping[str, DataFrame],
    items: Sequence[Item], *, rows_per_file: int = snapshots.ROWS_PER_FILE,
) -> snapshots.Version:
    """The state after a day: ``came`` added and ``gone``, rows counted before, taken away.

    ``items`` are those that the state was started with. Only count files that
    hold a value of the day's rows are opened for their rows and written anew.
    A second writer who publishes first makes this one fail (Conflict).
    """
    base = snapshots.latest(spark, root)
    state = base.tables[TABLE]
    weighed = {
        name: came[name].withColumn(_WEIGHT, F.lit(1)).unionByName(gone[name].withColumn(_WEIGHT, F.lit(-1)))
        for name in came
    }
    totals = dict(state.notes["totals"])
    for name, df in weighed.items():
        totals[name] = [a + b for a, b in zip(totals[name], _totals(df, _of(items, name)))]
    delta = stage(_counts(spark, weighed, items).where("rows != 0 OR hits != 0"), "dq-delta")

    found = snapshots.files_holding(snapshots.manifest_of(spark, state), "place", delta.select("place"))
    opened = [r[0] for r in found.select("path").distinct().orderBy("path").collect()]
    before = snapshots.read_files(spark, state, opened)
    after = stage(
        before.unionByName(delta).groupBy("slot", "place").agg(F.sum("rows").alias("rows"), F.sum("hits").alias("hits"))
        .where("rows != 0 OR hits != 0"), "dq-counts")
    if any(n < 0 for sums in totals.values() for n in sums) or after.where("rows < hits OR hits < 0 OR rows <= 0").head(1):
        raise StateMismatch(f"rows taken away from {root} were not counted in version {base.number}")
    was, now = _wrong(before, items), _wrong(after, items)
    wrong = {slot: n + now[slot] - was[slot] for slot, n in state.notes["wrong"].items()}
    notes = {"totals": totals, "wrong": wrong}
    grown = snapshots.replace_files(spark, root, TABLE, state, opened, after, rows_per_file=rows_per_file, notes=notes)
    return snapshots.commit(spark, root, base, {TABLE: grown})


def suite(spark: SparkSession, version: snapshots.Version, items: Sequence[Item], as_of: dt.datetime) -> DataFrame:
    """``quality.run_suite`` of the tables that a version has counted, from its sums alone."""
    notes = version.tables[TABLE].notes
    frames = []
    for table in dict.fromkeys(i.table for i in items):
        own = _of(items, table)
        if table not in notes["totals"]:
            frames.append(_not_measured(spark, own, f"table {table} not found", as_of))
            continue
        rows, *hits = notes["totals"][table]
        matching = dict(zip([i.measure for i in own if i.measure.kind not in GROUPED], hits))
        actuals = [
            f"cast({notes['wrong'][_slot(i)]} AS double)" if i.measure.kind in GROUPED
            else _actual(i.measure.kind, rows, matching[i.measure])
            for i in own
        ]
        frames.append(_unfold(spark.range(1), own, actuals, as_of))
    return reduce(DataFrame.unionByName, frames)


def day_changes(
    latest: DataFrame, batch: DataFrame, entity: str, as_of: dt.datetime, *, counted_as_of: dt.datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Silver rows that a batch of Bronze replaces, and those that it puts in their place.

    ``latest`` has the newest Bronze row of each key so far, from which Silver
    was made on ``counted_as_of``. Rows of other keys are left out of both; a
    missing key is a key.
    """
    key = BUSINESS_KEY[entity]
    keys = stage(batch.select(F.col(key).alias("_batch_key")).distinct(), "batch-keys")
    replaced = latest.join(
        broadcast_if_small(keys, MAX_BATCH_KEYS), F.col(key).eqNullSafe(F.col("_batch_key")), "left_semi")
    touched = stage(replaced, "replaced-rows")
    newest = latest_per_key(touched.unionByName(batch), entity)
    return clean_silver(touched, entity, counted_as_of or as_of), clean_silver(newest, entity, as_of)


# ---- sums ----------------------------------------------------------------------
def _of(items: Sequence[Item], table: str) -> list[Item]:
    return [i for i in items if i.table == table]


def _slot(item: Item) -> str:
    """The name of a uniqueness rule's counts; rules that count the same share them."""
    return f"{item.table}.{item.measure.column}:{item.measure.kind}:{item.measure.predicate}"


def _slots(items: Sequence[Item]) -> dict[str, Item]:
    return {_slot(i): i for i in items if i.measure.kind in GROUPED}


def _actual(kind: str, rows: int, hits: int) -> str:
    if kind == "percent":
        return f"round(cast({hits} AS double) * 100.0D / nullif({rows}, 0), 2)"
    return f"cast({rows if kind == 'rows' else hits} AS double)"


def _totals(weighed: DataFrame, own: Sequence[Item]) -> list[int]:
    """Rows of a table, then those that match each row rule: one aggregate, one row."""
    sums: list[Column] = [F.sum(_WEIGHT)]
    for measure in (i.measure for i in own if i.measure.kind not in GROUPED):
        sums.append(F.sum(F.expr(f"if({measure.predicate or 'false'}, {_WEIGHT}, 0)")))
    row = weighed.agg(*[F.coalesce(s, F.lit(0)).alias(f"s{n}") for n, s in enumerate(sums)]).first()
    return list(row)


def _counts(spark: SparkSession, weighed: Mapping[str, DataFrame], items: Sequence[Item]) -> DataFrame:
    """COUNTS of all uniqueness rules; those of one table are counted in one pass over it."""
    frames = [spark.createDataFrame([], COUNTS)]
    for name, df in weighed.items():
        slots = _slots(_of(items, name))
        if not slots:
            continue
        cells = [
            F.struct(
                F.lit(slot).alias("slot"),
                # A missing value is a value, and unlike any text.
                F.coalesce(F.concat(F.lit("="), F.col(i.measure.column).cast("string")), F.lit("?")).alias("value"),
                F.expr(f"if({i.measure.predicate or 'true'}, {_WEIGHT}, 0)").alias("hit"))
            for slot, i in slots.items()
        ]
        frames.append(
            df.select(_WEIGHT, F.inline(F.array(*cells))).groupBy("slot", "value")
            .agg(F.sum(_WEIGHT).alias("rows"), F.sum("hit").alias("hits"))
            .select("slot", F.concat_ws("", "slot", "value").alias("place"), "rows", "hits"))
    return reduce(DataFrame.unionByName, frames)


def _wrong(counts: DataFrame, items: Sequence[Item]) -> dict[str, int]:
    """Values that break each uniqueness rule: one row a rule comes to the driver."""
    slots = _slots(items)
    repeats = [s for s, i in slots.items() if i.measure.kind == "repeats"]
    breaks = F.when(F.col("slot").isin(repeats), F.col("rows") > 1).otherwise(F.col("hits") != 1)
    found = {r["slot"]: r["n"] for r in counts.groupBy("slot").agg(F.count_if(breaks).alias("n")).collect()}
    return {slot: found.get(slot, 0) for slot in slots}
