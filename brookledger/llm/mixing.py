"""Mixing sources to target weights with weights that change over training."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookledger.llm.row_keys import free_names
from brookledger.llm.shared_folder import written

#: The weights that sources take in turn, and how often a source may be repeated.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Slope of a source's weight over training, by its place in the order of sources:
#: the weight at time t of 0 to 1 is proportional to 1 + slope * (2 t - 1).
SLOPES = (-0.5, 0.0, 0.5)
#: Groups that one source's documents are summed in before the running sums.
BUCKETS = 4096


def n_words(text: Column) -> Column:
    """Number of longest runs of characters that are not blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, ordinal, target) from rows (source, source_size).

    All sizes are shared by weight; what exceeds MAX_REPEATS times a source's
    size goes to the others by weight, until none exceeds it. That fixed point
    is a water level: sources in the order of (limit / weight) are full while
    the level that the rest would get, without them, is at their limit or above.
    The rows are one per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level_at_limit", "ordinal")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    listed = (
        sizes.withColumn("ordinal", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("ordinal") % len(WEIGHTS) + 1).cast("double"))
        .withColumn("limit", F.col("source_size").cast("double") * MAX_REPEATS)
        .withColumn("level_at_limit", F.col("limit") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("full", F.col("level") >= F.col("level_at_limit"))
        # Only a leading run of the order can be full.
        .withColumn("full", F.min("full").over(by_level.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("shared_level", F.min(F.when(~F.col("full"), F.struct("level_at_limit", "ordinal", "level"))).over(Window.partitionBy())["level"])
    )
    return listed.select(
        "source", "source_size", "ordinal",
        F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * F.col("shared_level")).alias("target"),
    )


def time_of(share: Column, ordinal: Column) -> Column:
    """When a source has given ``share`` (0 to 1) of its target: the inverse of the integral of its weight.

    The integral of 1 + s (2 t - 1) up to t is t (1 - s) + s t².
    """
    s = F.element_at(F.array(*map(F.lit, SLOPES)), (ordinal % len(SLOPES) + 1).cast("int"))
    root = F.sqrt((1 - s) * (1 - s) + 4 * s * share)
    return F.when(s == 0, share).otherwise((root - (1 - s)) / (2 * s))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    """One row per input row: doc_id, size, source, source_size, target, copies, taken, shares.

    A source's documents are laid end to end in a random but repeatable order
    (by MD5 of seed and id), up to MAX_REPEATS times; a copy is in the mix when
    its middle is before the target, so a source misses its target by half a
    document at most. ``shares`` has, for each copy, the part of the source's
    target that is used up where it begins, and ``times`` the training time at
    which the source's schedule reaches that part.

    Null text counts no words and is never taken, like any document without
    words; a null source is a source of its own, last in the order; a null id
    is ordered like the text 'null'. Rows that tie in all of that are equal, and
    which comes first does not matter. Other columns are ignored.

    Sizes are summed per (source, bucket of the order) before any running sum,
    so a source with a third of all rows is BUCKETS groups.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), key.alias("key"),
        F.xxhash64(F.col(text)).alias("content"),
    ).withColumn("bucket", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % BUCKETS).cast("int"))
    sized = written(sized, "sizes")
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        buckets.withColumn("bucket_from", F.coalesce(F.sum("bucket_size").over(order), F.lit(0)))
        .join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "bucket_size")
        .withColumnsRenamed({"source": "s", "bucket": "b"})
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "content").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(begins, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("start", F.col("bucket_from") + F.col("within"))
    )
    copies = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1)), lambda k: k * F.col("source_size") + F.col("start")),
        lambda at: (F.col("size") > 0) & (2 * at + F.col("size") < 2 * F.col("target")),
    )
    return (
        laid.withColumn("copies", copies)
        .withColumn("taken", F.size("copies") * F.col("size"))
        .withColumn("times", F.transform("copies", lambda at: time_of(at / F.col("target"), F.col("ordinal"))))
        .select("doc_id", "size", "source", "source_size", "target", "taken", "content",
                F.size("copies").alias("copies"), "times")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix with their own columns, a row for each copy, in training order.

    A document is found by id, source and a hash of its text. Rows that repeat
    all three cannot be told apart by that: they, and only they, are made one
    row by an aggregate, which then stands for all their copies.
    """
    names = docs.columns
    keys = free_names(names, "_id", "_source", "_content")
    marks = free_names(names, "_plan_id", "_plan_source", "_plan_content")
    times, time = free_names(names, "_times", "_time")
    planned = mixture(docs, doc_id, text, source).where("copies > 0").groupBy("doc_id", "source", "content").agg(
        F.sort_array(F.flatten(F.collect_list("times"))).alias(times), F.count(F.lit(1)).alias("n_rows"))
    plan = written(planned.withColumnsRenamed(dict(zip(("doc_id", "source", "content"), marks))), "mix")
    keyed = docs.withColumns(dict(zip(keys, (F.col(doc_id), F.col(source), F.xxhash64(F.col(text))))))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks)))

    def found(wanted: DataFrame, rows: DataFrame) -> DataFrame:
        return rows.join(wanted.drop("n_rows"), same).select(*names, times, keys[0])

    chosen = found(plan.where("n_rows = 1"), keyed)
    repeated = plan.where("n_rows > 1")
    if not repeated.isEmpty():
        several = keyed.join(repeated.select(*marks), same, "left_semi").dropDuplicates(keys)
        chosen = chosen.unionAll(found(repeated, several))
    return chosen.select(*names, F.explode(times).alias(time), keys[0]).orderBy(time, keys[0]).select(*names)
