"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.shared_folder import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")).hint("rebalance")
    return (
        both.where(F.col("b") > F.col("a")).join(lowest, "a")
        .select(F.col("low").alias("a"), "b").where(F.col("a") != F.col("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    lowest = edges.groupBy("b").agg(F.min("a").alias("low")).hint("rebalance")
    joined = edges.join(lowest, "b")
    return (
        joined.select(F.col("low").alias("a"), F.col("a").alias("b"))
        .unionAll(lowest.select(F.col("low").alias("a"), "b"))
        .where(F.col("a") != F.col("b")).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that have an edge.

    edges: columns a and b of any orderable type; loops, repeats and nulls are
    ignored. Each round is written out and shortens the longest path; it stops
    when a round changes nothing. Minima are combined before the shuffle and
    dealt anew before they are joined, so that both sides of the join are plain
    exchanges, whose hot partitions adaptive execution splits.
    """
    known = written(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first())

    before = state(known)
    while before[0]:
        known = written(_small_star(_large_star(known)), "edges")
        now = state(known)
        if now == before:
            break
        before = now
    return known.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        known.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
