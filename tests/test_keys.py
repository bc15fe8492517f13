from __future__ import annotations

import hashlib

import pytest

from brookledger.operators.keys import bucket_digits, with_dense_key, with_lasting_key


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_keys_are_dense_and_do_not_depend_on_buckets(spark, digits):
    rows = spark.range(5000, numPartitions=7).selectExpr("concat('ID', id) AS name", "id")
    keyed = with_dense_key(rows, "key", "name", digits=digits).collect()
    ids = sorted((f"ID{i}" for i in range(5000)), key=lambda s: (hashlib.md5(s.encode()).hexdigest(), s))
    assert {r.name: r.key for r in keyed} == {name: n + 1 for n, name in enumerate(ids)}


def test_equal_and_missing_ids_still_get_keys_of_their_own(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 3)], "name string, v int")
    keyed = with_dense_key(rows, "key", "name", tie_break=[rows.v]).collect()
    assert sorted(r.key for r in keyed) == [1, 2, 3]
    first, second = sorted((r for r in keyed if r.name == "a"), key=lambda r: r.key)
    assert (first.v, second.v) == (1, 2)


def test_empty_input(spark):
    assert with_dense_key(spark.range(0).selectExpr("'x' AS name"), "key", "name").count() == 0


def test_buckets_follow_the_shuffle_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, digits in (("2", 2), ("8", 3), ("200", 4), ("1000", 4), ("100000", 5)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert bucket_digits(spark) == digits
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lasting_keys_follow_known_ones_in_the_order_of_dense_keys(spark):
    """Repeated new ids, missing ids, ids known twice and an empty one, against plain Python."""
    rows = [(f"n{k % 40}", k) for k in range(60)] + [(None, 100), (None, 101), ("", 102)] + [(f"k{k}", 200 + k) for k in range(5)]
    table = spark.createDataFrame(rows, "name string, v int").repartition(5)
    known = spark.createDataFrame([(f"k{k}", 10 + k) for k in range(4)] + [("k1", 90), (None, 7)], "name string, key long")
    got = {(r.name, r.v): r.key for r in with_lasting_key(table, "key", "name", known, tie_break=[table.v]).collect()}
    new = [r for r in rows if r[0] not in {f"k{k}" for k in range(4)}]
    new.sort(key=lambda r: (hashlib.md5((r[0] or "").encode()).hexdigest(), r[0] is not None, r[1]))
    want = {r: 91 + n for n, r in enumerate(new)} | {(f"k{k}", 200 + k): 10 + k for k in range(4)}
    assert got == want


def test_lasting_keys_of_empty_sides(spark):
    none = spark.createDataFrame([], "name string, key long")
    one = spark.createDataFrame([("a",)], "name string")
    assert [r.key for r in with_lasting_key(one, "key", "name", none).collect()] == [1]
    assert with_lasting_key(one.limit(0), "key", "name", none).count() == 0


def test_lasting_keys_move_the_wide_rows_once(spark, tmp_path):
    spark.range(1000).selectExpr("concat('ID', id) AS name", "repeat('x', 50) AS wide").write.parquet(f"{tmp_path}/rows")
    spark.range(500).selectExpr("concat('ID', id) AS name", "id AS key").write.parquet(f"{tmp_path}/known")
    keyed = with_lasting_key(spark.read.parquet(f"{tmp_path}/rows"), "key", "name", spark.read.parquet(f"{tmp_path}/known"))
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "wide" in line for line in plan.splitlines()) == 1
