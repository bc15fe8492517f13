"""State as of a row's own day, by merging days and versions instead of joining by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DAY, _STATE, _SINCE, _UNTIL = "_day", "_state", "_since", "_until"


def state_on_days(
    days: DataFrame, versions: DataFrame, key: str, since: str, until: str, columns: list[str]
) -> DataFrame:
    """(key, day, columns) for each distinct (key, day): the version that covers the day, or NULL.

    ``days`` has the columns ``key`` and ``_day``. Versions of a key that cover
    any day (``since`` <= ``until``) do not overlap. Days and versions of a key
    are read as one sorted stream in which the last version is carried on, so
    a day meets one version, however many there are. A key costs its distinct
    days and versions, never its rows.
    """
    state = F.struct(F.col(since).alias(_SINCE), F.col(until).alias(_UNTIL), *columns)
    begun = versions.where(F.col(since) <= F.col(until)).select(
        key, F.col(since).alias(_DAY), state.alias(_STATE), F.lit(True).alias("_begins"))
    # A plain NULL would not have the type of the versions' column.
    asked = days.distinct().select(key, _DAY, F.lit(None).cast(begun.schema[_STATE].dataType).alias(_STATE), F.lit(False).alias("_begins"))
    stream = Window.partitionBy(key).orderBy(F.col(_DAY), F.col("_begins").desc()).rowsBetween(Window.unboundedPreceding, 0)
    carried = begun.unionByName(asked).withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(stream)).where("NOT _begins")
    covers = F.col(_DAY) <= F.col(f"{_STATE}.{_UNTIL}")
    return carried.select(key, _DAY, *[F.when(covers, F.col(f"{_STATE}.`{c}`")).alias(c) for c in columns])


def with_state(
    rows: DataFrame, versions: DataFrame, *, key: str, day: Column, since: str, until: str, columns: list[str]
) -> DataFrame:
    """Each row once, with ``columns`` of the version that covers its day; none leaves NULL.

    The days that a key has rows on are counted out before any shuffle, merged
    with its versions, and joined back by (key, day). A key with a third of all
    rows is spread over its days there, and rows without key or day, which no
    version covers, are not shuffled at all.
    """
    dated = rows.withColumn(_DAY, day)
    known = F.col(key).isNotNull() & F.col(_DAY).isNotNull()
    states = state_on_days(dated.where(known).select(key, _DAY), versions, key, since, until, columns)
    met = dated.where(known).join(states, [key, _DAY], "left").select(*rows.columns, *columns)
    types = {c: versions.schema[c].dataType for c in columns}
    unmet = dated.where(~known).select(*rows.columns, *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return met.unionByName(unmet)
