"""Exact dedup by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition is a run. A round joins FAN_IN neighbouring runs into one:
each task sorts its entries and combines equal neighbours, sends them to the task
of their digest, and there the sorted entries of all runs of a group are merged.
A run that is the result of several lies over as many tasks as they had, so no
task ever holds a whole run, and the last round leaves one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookledger.llm.row_keys import rows_of_keys
from brookledger.llm.shared_folder import written

#: Fixed value: the characters that do not count when texts are compared.
IGNORED = r"[\x20\x09-\x0D]+"
#: Runs that one merge takes in, a power of two; the number of rounds is the logarithm of the partitions to this base.
FAN_IN = 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), IGNORED, "")


def _merge(runs: DataFrame) -> DataFrame:
    """One level: equal entries of the runs of a group become one, which keeps the best row.

    An entry is equal only if digest, second hash and length all are: the
    digest alone is never trusted. The best row is a struct, for which Spark
    aggregates by sorting: on both sides of the exchange it sorts by group and
    digest and combines neighbours (a test reads that off the plan).
    """
    return runs.groupBy("run", "digest", "check", "n_points").agg(
        F.sum("members").alias("members"),
        F.max("rank").alias("rank"),
    )


def digest_entries(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One entry per row: its run (input partition), place, digest and lengths."""
    reduced = docs.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("id"),
        normalised(F.col(text)).alias("reduced"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("points"),
    )
    return reduced.select(
        "run", "row", "id",
        F.unhex(F.sha2("reduced", 256)).alias("digest"),
        F.xxhash64("reduced").alias("check"),
        F.length("reduced").cast("long").alias("n_points"),
        "points",
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without blanks (null: empty). Of equal
    texts the row with the most code points stays, then the smallest id, of
    repeated rows one. A null id comes after all others; where it wins, keep_id
    is null. Other columns are ignored; an empty table gives an empty one.

    The runs are the input partitions. A round of the tree merges runs
    k * fan_in to (k + 1) * fan_in - 1 into run k, so runs meet first those
    nearest to them and after r rounds those up to fan_in ** r away. Each run
    holds a text once, also one that is a third of all rows: it reaches a merge
    at most fan_in times. Each row then finds its group's winner by an inner
    join on the digest, in which adaptive execution splits a hot digest.
    """
    entries = written(digest_entries(docs, doc_id, text), "digests")
    level = entries.select(
        (F.floor(F.col("run") / fan_in)).alias("run"), "digest", "check", "n_points", F.lit(1).cast("long").alias("members"),
        F.struct(
            "points",
            F.col("id").isNotNull().alias("named"),
            (-F.coalesce(F.col("id"), F.lit(0)).cast("decimal(20,0)")).alias("minus_id"),
            (-F.col("row")).alias("minus_row"),
        ).alias("rank"),
    )
    runs = entries.agg(F.max("run")).first()[0] or 0
    level, runs = _merge(level), runs // fan_in
    while runs:
        level = _merge(level.withColumn("run", F.floor(F.col("run") / fan_in)))
        runs //= fan_in
    winners = level.select(
        "digest", "check", "n_points", F.col("members").alias("group_size"),
        (-F.col("rank.minus_row")).alias("keep_row"),
        F.when(F.col("rank.named"), (-F.col("rank.minus_id")).cast("long")).alias("keep_id"),
    )
    return entries.join(winners, ["digest", "check", "n_points"]).select(
        F.col("id").alias("doc_id"),
        "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; found by id and digest."""
    kept = written(exact_dedup(docs, doc_id, text).where("kept"), "kept")
    digest = F.sha2(normalised(F.col(text)), 256)
    return rows_of_keys(docs, doc_id, digest, kept.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("content")))
