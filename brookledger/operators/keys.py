"""Dense surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bucket of an id's digest; rows are dealt by it when they are numbered.
BUCKET = "_key_bucket"
_BUCKET = BUCKET
_DIGEST = "_key_digest"
_BEFORE = "_keys_before"
_ID, _NO_ID, _KEY, _ROWS, _FROM = "_key_id", "_key_no_id", "_key_known", "_key_rows", "_key_from"
_MIN_DIGITS, _MAX_DIGITS = 2, 5


def bucket_digits(spark: SparkSession) -> int:
    """Hex digits of the id digest that name a bucket.

    Enough buckets for 64 per shuffle partition, so that the partitions come
    out even, at most 16**5 (about a million), which also bounds the offset
    table that is broadcast. The keys do not depend on the choice: they follow
    (digest, id) order throughout.
    """
    wanted = 64 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    digits = _MIN_DIGITS
    while digits < _MAX_DIGITS and 16**digits < wanted:
        digits += 1
    return digits


def with_dense_key(
    rows: DataFrame,
    key_name: str,
    id_name: str,
    *,
    tie_break: list[Column] | None = None,
    digits: int | None = None,
    keep_bucket: bool = False,
) -> DataFrame:
    """Number the rows 1..n in the order of (md5(id), id).

    Rows are numbered inside buckets of the digest, which is uniform whatever
    the ids look like, and each bucket starts after the rows of the buckets
    before it. ``rows`` is read twice, once for its ids alone: pass a stored
    table, not a long plan. ``tie_break`` orders rows that share an id. With
    ``keep_bucket`` the result has the column BUCKET, by which its rows lie.
    """
    digits = digits or bucket_digits(rows.sparkSession)
    digest = _digest_of(id_name)
    bucket = F.substring(digest, 1, digits)

    sizes = rows.groupBy(bucket.alias(_BUCKET)).agg(F.count(F.lit(1)).alias("_size"))
    # One row per bucket: a bounded table, so one running sum is fine.
    running = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _BUCKET, F.coalesce(F.sum("_size").over(running), F.lit(0)).alias(_BEFORE)
    )

    in_bucket = Window.partitionBy(_BUCKET).orderBy(
        F.col(_DIGEST), F.col(id_name), *(tie_break or [])
    )
    numbered = rows.withColumn(_DIGEST, digest).withColumn(
        _BUCKET, F.substring(_DIGEST, 1, digits)
    )
    numbered = numbered.withColumn(
        key_name, F.row_number().over(in_bucket).cast("long")
    )
    # Every bucket has an offset; a left join spares the scan a null test.
    return numbered.join(F.broadcast(offsets), _BUCKET, "left").select(
        (F.col(key_name) + F.col(_BEFORE)).alias(key_name),
        *[numbered[c] for c in rows.columns],
        *([F.col(_BUCKET)] if keep_bucket else []),
    )


def _digest_of(id_name: str) -> Column:
    return F.md5(F.coalesce(F.col(id_name), F.lit("")).cast("binary"))


def with_bucket(rows: DataFrame, id_name: str, digits: int | None = None) -> DataFrame:
    """Add the BUCKET of an id, as ``with_dense_key`` has it."""
    digits = digits or bucket_digits(rows.sparkSession)
    return rows.withColumn(BUCKET, F.substring(_digest_of(id_name), 1, digits))


def with_lasting_key(
    rows: DataFrame,
    key_name: str,
    id_name: str,
    known: DataFrame,
    *,
    tie_break: list[Column] | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """Members in ``known`` keep their key; only new ids are numbered, after the largest.

    ``last_key`` is the largest key given so far where ``known`` does not hold all of them.

    ``known`` has the columns ``id_name`` and ``key_name``; of an id that it
    holds more than once the smallest key counts. A NULL id is new each time.
    Keys are found on the ids alone: known and present ids meet in one narrow
    aggregate, and each new id gets a place after the rows of the ids before it.
    The wide rows then move once, to their id. ``rows`` is read twice, once for
    its ids: pass a stored table.
    """
    digits = bucket_digits(rows.sparkSession)
    at = [_ID, _NO_ID]
    placed = {_ID: F.coalesce(F.col(id_name), F.lit("")), _NO_ID: F.col(id_name).isNull()}
    given = known.where(F.col(id_name).isNotNull()).withColumns(placed).select(
        *at, F.col(key_name).cast("long").alias(_KEY), F.lit(0).cast("long").alias(_ROWS))
    present = rows.select(id_name).withColumns(placed).select(
        *at, F.lit(None).cast("long").alias(_KEY), F.lit(1).cast("long").alias(_ROWS))
    ids = given.unionByName(present).groupBy(*at).agg(F.min(_KEY).alias(_KEY), F.sum(_ROWS).alias(_ROWS)).where(F.col(_ROWS) > 0)
    fresh = F.when(F.col(_KEY).isNull(), F.col(_ROWS)).otherwise(0)
    ids = ids.withColumn(_DIGEST, _digest_of(_ID)).withColumn(_BUCKET, F.substring(_DIGEST, 1, digits))
    sizes = ids.groupBy(_BUCKET).agg(F.sum(fresh).alias("_size"))
    # One row per bucket, as in with_dense_key.
    running = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BUCKET, F.coalesce(F.sum("_size").over(running), F.lit(0)).alias(_BEFORE))
    in_bucket = Window.partitionBy(_BUCKET).orderBy(_DIGEST, F.desc(_NO_ID)).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ids.withColumn(_FROM, F.coalesce(F.sum(fresh).over(in_bucket), F.lit(0))).join(
        F.broadcast(offsets), _BUCKET, "left"
    ).select(*at, _KEY, (F.col(_FROM) + F.col(_BEFORE)).alias(_FROM))
    last = known.agg(F.coalesce(F.max(key_name), F.lit(0))).scalar() if last_key is None else F.lit(last_key)
    in_id = Window.partitionBy(*at).orderBy(*(tie_break or [F.lit(1)]))
    return rows.withColumns(placed).join(numbered, at).withColumn(
        key_name, F.coalesce(F.col(_KEY), last + F.col(_FROM) + F.row_number().over(in_id)).cast("long")
    ).select(key_name, *rows.columns)
