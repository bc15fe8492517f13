"""Latest row per business key, and the rows it supersedes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.fixed_values import BUSINESS_KEY, SOURCE_COLUMNS
from brookledger.sources.tables import stage

_RANK = "_rank"
_SLICE = "_slice"


def _newest_first(entity: str) -> str:
    """Load time, then source file, then every source column.

    The trailing columns make the choice among rows of one load repeatable;
    they are compared only where everything before them is equal.
    """
    ties = [c for c in SOURCE_COLUMNS[entity] if c != BUSINESS_KEY[entity]]
    return ", ".join(
        [
            "_load_timestamp DESC NULLS FIRST",
            "_source_file DESC NULLS LAST",
            *[f"{c} DESC NULLS LAST" for c in ties],
        ]
    )


def _with_rank(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    window = f"PARTITION BY {', '.join(keys)} ORDER BY {order}"
    return rows.withColumn(_RANK, F.expr(f"row_number() OVER ({window})"))


def latest_per_key(
    raw: DataFrame, entity: str, *, normalize_key: bool = False
) -> DataFrame:
    """One row per business key; NULL keys form one group like any other.

    Spark turns the rank filter into a group limit that runs before the
    shuffle too, so each task sends at most one row per key and a key (or
    NULL) holding a third of the table costs one row per input split.

    The key is compared as written unless ``normalize_key`` trims it first.
    """
    key = BUSINESS_KEY[entity]
    if normalize_key:
        raw = raw.withColumn(key, F.trim(key))
    return _with_rank(raw, [key], _newest_first(entity)).filter(f"{_RANK} = 1").drop(_RANK)


def roll_forward(
    latest: DataFrame, batch: DataFrame, entity: str, *, max_batch_keys: int = 2_000_000
) -> DataFrame:
    """The latest rows after one more batch, without rereading older batches.

    ``latest`` is what ``latest_per_key`` gave for all batches so far. The
    result equals a dedup over all of Bronze, because the newest of some
    rows' newest is the newest of all of them.

    A batch counted to hold few keys is broadcast by key: rows it does not
    touch pass through unshuffled, and only the touched ones are compared. A
    larger batch is compared with all rows in one shuffle.
    """
    key = BUSINESS_KEY[entity]
    keys = batch.select(F.col(key).alias("_batch_key")).distinct()
    if keys.count() > max_batch_keys:
        return latest_per_key(latest.unionByName(batch), entity)
    in_batch = F.col(key).eqNullSafe(F.col("_batch_key"))
    untouched = latest.join(F.broadcast(keys), in_batch, "left_anti")
    touched = latest.join(F.broadcast(keys), in_batch, "left_semi")
    return untouched.unionByName(latest_per_key(touched.unionByName(batch), entity))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, counted from the key column alone.

    The count is combined before its shuffle, so a hot key costs one row per
    input split. NULL counts as a key.
    """
    return (
        rows.groupBy(F.col(key).alias("_repeated_key"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select("_repeated_key")
    )


def all_but_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Every row but the first of its key in the given order.

    A plain ``rank > 1`` would sort a whole hot key in one task. Here:

    1. only rows of repeated keys go on, and are stored for the two passes
       below;
    2. they are ranked inside (key, input split), which spreads a hot key over
       as many tasks as it has splits: rank > 1 is not the first of its key;
    3. the best row of each (key, split) is ranked over the key, and all but
       the best of those are not first either.
    """
    suspects = stage(
        rows.withColumn(_SLICE, F.spark_partition_id()).join(
            repeated_keys(rows, key),
            F.col(key).eqNullSafe(F.col("_repeated_key")),
            "left_semi",
        ),
        "repeated-keys",
    )
    sliced = _with_rank(suspects, [key, _SLICE], order)
    later_in_slice = sliced.filter(f"{_RANK} > 1")
    best_of_slice = sliced.filter(f"{_RANK} = 1")
    later_over_key = _with_rank(best_of_slice, [key], f"{order}, {_SLICE}").filter(
        f"{_RANK} > 1"
    )
    return later_in_slice.unionByName(later_over_key).drop(_RANK, _SLICE)


def superseded_rows(
    raw: DataFrame, entity: str, *, normalize_key: bool = False
) -> DataFrame:
    """Every row that ``latest_per_key`` leaves out."""
    key = BUSINESS_KEY[entity]
    if normalize_key:
        raw = raw.withColumn(key, F.trim(key))
    return all_but_first(raw, key, _newest_first(entity))
