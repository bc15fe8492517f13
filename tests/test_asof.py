"""The merge as-of join against a look at every version of every row."""

from __future__ import annotations

import datetime as dt
import random

from conftest import executed_plan_of, rows_of
from pyspark.sql import functions as F

from brookledger.operators.asof import state_on_days, with_state

BEGIN = dt.date(2024, 1, 1)
VERSIONS = "id string, since date, until date, status string, rank int"


def day(n):
    return BEGIN + dt.timedelta(days=n)


def made(seed):
    draw = random.Random(seed)
    versions = []
    for k in range(12):
        at = draw.randint(0, 5)
        while at < 40:
            length = draw.randint(-1, 9)  # below 0: replaced on the day it began
            versions.append((f"K{k}", day(at), day(at + length), draw.choice(["A", "B", None]), draw.randint(0, 3)))
            at += max(length + 1, 0) + draw.choice([0, 0, 0, 4])
    rows = [(n, draw.choice([f"K{k}" for k in range(14)] + [None]), draw.choice([day(d) for d in range(-2, 60)] + [None])) for n in range(600)]
    return versions, rows


def expected(versions, rows):
    out = []
    for n, key, at in rows:
        hits = [v for v in versions if None not in (key, at) and v[0] == key and v[1] <= at <= v[2]]
        assert len(hits) <= 1
        out.append((n, key, at, *(hits[0][3:] if hits else (None, None))))
    return out


def joined(spark, versions, rows):
    facts = spark.createDataFrame(rows, "n int, id string, at date")
    return with_state(
        facts, spark.createDataFrame(versions, VERSIONS), key="id", day=F.col("at"), since="since", until="until", columns=["status", "rank"])


def test_like_a_look_at_every_version(spark):
    for seed in range(3):
        versions, rows = made(seed)
        assert rows_of(joined(spark, versions, rows)) == sorted(
            expected(versions, rows), key=lambda t: [(v is not None, str(v)) for v in t])


def test_empty_sides(spark):
    versions, rows = made(9)
    assert joined(spark, versions, []).count() == 0
    assert {r.status for r in joined(spark, [], rows).collect()} == {None}


def test_a_hot_key_costs_its_days_and_lies_in_several_tasks(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(60_000).select(
            F.lit("HOT").alias("id"), F.date_add(F.lit(BEGIN), (F.col("id") % 50).cast("int")).alias("at"))
        versions = spark.range(25).select(
            F.lit("HOT").alias("id"), F.date_add(F.lit(BEGIN), (2 * F.col("id")).cast("int")).alias("since"),
            F.date_add(F.lit(BEGIN), (2 * F.col("id") + 1).cast("int")).alias("until"), F.col("id").cast("string").alias("status"))
        asked = facts.select("id", F.col("at").alias("_day"))
        assert state_on_days(asked, versions, "id", "since", "until", ["status"]).count() == 50
        result = with_state(facts, versions, key="id", day=F.col("at"), since="since", until="until", columns=["status"])
        split = result.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in split) == 60_000 and len([r for r in split if r["count"]]) > 3
        assert {r["count"] for r in result.groupBy("status").count().collect()} == {2_400}
        assert "BroadcastNestedLoopJoin" not in executed_plan_of(result)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
