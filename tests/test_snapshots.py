"""Versioned tables: one state of all tables for readers, conflicts, the file index, copy-on-write of history."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import executed_plan_of, rows_of
from pyspark.sql import functions as F

from brookledger.plans import history_store, scd2
from brookledger.plans.gold import dim_customers
from brookledger.plans.silver import to_silver
from brookledger.sources import snapshots
from brookledger.sources.tables import stage

DAY = dt.datetime(2024, 3, 1)


def numbers(spark, n, value="v"):
    return spark.range(n).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"), F.lit(value).alias("v"))


def test_readers_see_one_state_of_all_tables(spark, tmp_path):
    root = str(tmp_path)
    tables = ("dim", "fact")
    made = {t: snapshots.create_table(spark, root, t, numbers(spark, 100, "one"), ["k"], rows_per_file=20) for t in tables}
    first = snapshots.commit(spark, root, snapshots.EMPTY, made)
    pinned = snapshots.latest(spark, root)
    replaced = {
        t: snapshots.replace_files(
            spark, root, t, first.tables[t], snapshots.file_paths(spark, first.tables[t]), numbers(spark, 50, "two"), rows_per_file=20)
        for t in tables}
    # Written, not yet published: nobody sees the new dimension with the old fact.
    assert {t: snapshots.read(spark, snapshots.latest(spark, root), t).first().v for t in tables} == {"dim": "one", "fact": "one"}
    second = snapshots.commit(spark, root, pinned, replaced)
    assert second.number == 2 and snapshots.latest(spark, root) == second
    for version, value, n in ((pinned, "one", 100), (second, "two", 50), (snapshots.at(spark, root, 1), "one", 100)):
        for t in tables:
            rows = snapshots.read(spark, version, t)
            assert rows.count() == n and {r.v for r in rows.collect()} == {value}


def test_the_second_of_two_writers_fails_clean(spark, tmp_path):
    root = str(tmp_path)
    base = snapshots.commit(
        spark, root, snapshots.EMPTY, {"t": snapshots.create_table(spark, root, "t", numbers(spark, 10), ["k"])})
    mine, theirs = (
        snapshots.replace_files(spark, root, "t", base.tables["t"], [], numbers(spark, 1, who)) for who in ("mine", "theirs"))
    won = snapshots.commit(spark, root, base, {"t": theirs})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, base, {"t": mine})
    assert snapshots.latest(spark, root) == won
    assert {r.v for r in snapshots.read(spark, won, "t").collect()} == {"v", "theirs"}
    assert [p.name for p in (tmp_path / "_log").iterdir() if p.name.endswith(".json")].__len__() == 2


def test_the_index_finds_every_file_and_few_others(spark, tmp_path):
    root = str(tmp_path)
    rows = numbers(spark, 20_000).withColumn("other", F.concat(F.lit("o"), F.pmod(F.xxhash64("k"), F.lit(9_000)).cast("string")))
    rows = rows.unionByName(spark.createDataFrame([(None, "v", None)], "k string, v string, other string"))
    state = snapshots.create_table(spark, root, "t", stage(rows, "rows"), ["k", "other"], rows_per_file=1_000)
    paths = snapshots.file_paths(spark, state)
    assert len(paths) >= 15
    truth = snapshots.read_files(spark, state, paths).withColumn("path", F.col("_metadata.file_path"))
    manifest = snapshots.manifest_of(spark, state)
    wanted = spark.range(0, 40_000, 97).select(F.concat(F.lit("K"), "id").alias("k"))
    found = {tuple(r) for r in snapshots.files_holding(manifest, "k", wanted).collect()}
    held = {tuple(r) for r in truth.join(wanted, "k", "left_semi").select("path", "k").collect()}
    assert held <= found and len(found - held) < 0.1 * wanted.count()
    # The second column lies in no order: only its Bloom filters keep files out.
    wanted = spark.range(0, 18_000, 997).select(F.concat(F.lit("o"), "id").alias("other"))
    found = {tuple(r) for r in snapshots.files_holding(manifest, "other", wanted).collect()}
    held = {tuple(r) for r in truth.join(wanted, "other", "left_semi").select("path", "other").collect()}
    assert held <= found and len(found - held) < 0.1 * wanted.count() * len(paths)


def broad_table(spark, root, n_files=12, rows_per_file=300):
    """A table in whose second key each file reaches over all hashes, its (path, k, other) and its manifest."""
    rows = numbers(spark, n_files * rows_per_file).withColumn("other", F.concat(F.lit("o"), F.reverse("k")))
    state = snapshots.create_table(spark, root, "t", stage(rows, "rows"), ["k", "other"], rows_per_file=rows_per_file)
    truth = snapshots.read_files(spark, state, snapshots.file_paths(spark, state)).select(F.col("_metadata.file_path").alias("path"), "k", "other")
    return stage(truth, "truth"), snapshots.manifest_of(spark, state)


def test_bins_of_a_file_are_not_sent_through_the_driver(spark, tmp_path):
    truth, manifest = broad_table(spark, str(tmp_path))
    wanted = stage(truth.select("other").limit(200), "wanted")
    found = snapshots.files_holding(manifest, "other", wanted)
    plan = executed_plan_of(found).split("Initial Plan")[0]
    joins = [line for line in plan.splitlines() if "Join" in line and "bin#" in line]
    assert joins and not any("Broadcast" in line for line in joins)
    held = {tuple(r) for r in truth.join(wanted, "other", "left_semi").select("path", "other").collect()}
    assert held <= {tuple(r) for r in found.collect()}


@pytest.mark.parametrize("crowd", [1, 5, 40, 4_096])
@pytest.mark.parametrize("step", [1, 13, 2_000])
def test_paths_of_several_sets(spark, tmp_path, monkeypatch, crowd, step):
    monkeypatch.setattr(snapshots, "CROWD", crowd)
    truth, manifest = broad_table(spark, str(tmp_path))
    paths = truth.select("path").distinct().count()
    ids = stage(spark.range(0, 7_200, step).select(F.concat(F.lit("K"), "id").alias("k")).unionByName(
        spark.createDataFrame([(None,), ("K0",)], "k string")), "ids")
    others = stage(spark.createDataFrame([("o7K",), ("o7K",), ("nowhere",), (None,)], "other string"), "others")
    held = {r[0] for x, key in ((ids, "k"), (others, "other")) for r in truth.join(x, key, "left_semi").select("path").collect()}
    found = snapshots.paths_holding(spark, manifest, [("k", ids), ("other", others)])
    assert held <= set(found) and found == sorted(set(found))
    assert step < 2_000 or crowd < 5 or len(found) < paths
    assert snapshots.paths_holding(spark, manifest, [("k", ids.limit(0)), ("other", others.where("other IS NULL"))]) == []


def test_the_index_of_keys_of_several_types(spark, tmp_path):
    root, n = str(tmp_path), 7_000
    rows = numbers(spark, n).withColumns({
        "number": F.when(F.col("k") != "K3", F.xxhash64("k") % 50), "gone": F.lit(None).cast("string"),
        "twice": F.substring("k", 1, 4)})
    keys = ["k", "number", "gone", "twice"]
    state = snapshots.create_table(spark, root, "t", stage(rows, "rows"), keys, rows_per_file=3_500)
    paths = snapshots.file_paths(spark, state)
    whole = snapshots.read_files(spark, state, paths).select(F.col("_metadata.file_path").alias("path"), *keys)
    hashed = whole.select("path", *keys, *[snapshots.key_hash(F.col(k)).alias(f"h_{k}") for k in keys]).collect()
    index = snapshots.manifest_of(spark, state).collect()
    assert {(r.path, r.key) for r in index} == {(p, k) for p in paths for k in keys}
    for path in paths:
        for key in keys:
            own = [r for r in index if (r.path, r.key) == (path, key)]
            held = {r[key]: r[f"h_{key}"] for r in hashed if r.path == path and r[key] is not None}
            size = sum(r.path == path for r in hashed)
            low, high, blocks = (min(held.values()), max(held.values()), -(-len(held) // snapshots.KEYS_PER_BLOCK)) if held else (None, None, None)
            assert {(r.rows, r.low, r.high, r.blocks) for r in own} == {(size, low, high, blocks)}
            assert [r.block for r in own if r.bits] == ([] if key == "gone" else list(dict.fromkeys(r.block for r in own)))
    wanted = spark.createDataFrame([(v,) for v in range(-50, 50)], "number long")
    truth = {(r.path, r.number) for r in hashed if r.number is not None}
    assert truth <= {tuple(r) for r in snapshots.files_holding(snapshots.manifest_of(spark, state), "number", wanted).collect()}
    assert snapshots.files_holding(snapshots.manifest_of(spark, state), "gone", rows.select("k")).count() == 0


def test_keys_of_one_type_are_dealt_once(spark, tmp_path):
    rows = numbers(spark, 100).withColumns({"a": F.reverse("k"), "b": F.upper("k")})
    rows.write.parquet(str(tmp_path / "files"))
    scans = [executed_plan_of(snapshots.index_files(spark, str(tmp_path / "files"), rows.schema, keys)).split("Initial Plan")[0].count("Scan parquet")
             for keys in (["k"], ["k", "a", "b"])]
    assert scans[0] == scans[1]


def test_a_crowd_of_values_meets_no_filter(spark, tmp_path, monkeypatch):
    """Values times files would be joined: each file reaches over all hashes of the second key."""
    truth, manifest = broad_table(spark, str(tmp_path))
    crowd = stage(spark.range(6_000).select(F.concat(F.lit("x"), "id").alias("other")), "crowd")
    asked = []
    monkeypatch.setattr(snapshots, "_probed", lambda *a: asked.append(a))
    assert set(snapshots.paths_holding(spark, manifest, [("other", crowd)])) == {r[0] for r in truth.select("path").collect()}
    assert asked == []


def customer(raw_id, status="active", **more):
    return {
        "customer_id": raw_id, "first_name": "Ann", "last_name": "Lee", "email": "a@b.c", "phone": "+1", "date_of_birth": "1990-01-01",
        "customer_since": "2015-01-01", "status": status, "credit_score": "700", **more}


@pytest.fixture
def history(spark, raw, tmp_path):
    """A dimension of 400 customers in many files, and the Silver rows of a day."""
    first = to_silver(raw("customers", *[customer(f"C{k:04d}") for k in range(400)]), "customers", DAY)
    dim = stage(scd2.bootstrap(dim_customers(stage(first, "s"), DAY), DAY), "d")
    root = str(tmp_path / "history")
    history_store.start(spark, root, dim, rows_per_file=20)

    def day(*rows):
        return to_silver(raw("customers", *rows), "customers", DAY)

    return root, dim, day


def holders(spark, version, *ids):
    rows = snapshots.read(spark, version, history_store.TABLE).where(F.col("customer_id").isin(*ids))
    return {r[0] for r in rows.select(F.col("_metadata.file_path")).collect()}


def test_a_day_rewrites_only_the_files_of_its_customers(spark, history):
    root, dim, day = history
    before = snapshots.latest(spark, root)
    files = set(snapshots.file_paths(spark, before.tables[history_store.TABLE]))
    assert len(files) >= 15
    silver = day(customer("C0007", "suspended"), customer("C0123"), customer("C0300", "inactive"), customer("NEW1"))
    run = history_store.apply_day(spark, root, silver, DAY, rows_per_file=20)
    after = set(snapshots.file_paths(spark, run.version.tables[history_store.TABLE]))
    assert set(run.rewritten) == holders(spark, before, "C0007", "C0300") == files - after
    assert holders(spark, before, "C0007", "C0300", "C0123") <= set(run.opened) and len(run.opened) <= 5
    whole = scd2.apply_history(dim, silver, DAY)
    names = sorted(dim.columns)
    assert rows_of(snapshots.read(spark, run.version, history_store.TABLE).select(*names)) == rows_of(whole.dimension.select(*names))
    assert run.summary.first() == whole.summary.first()


def test_days_add_up_and_repeat_to_nothing(spark, history):
    root, dim, day = history
    one = day(customer("C0001", "suspended"), customer("N1"))
    two = day(customer("C0001", "active"), customer("N1", "inactive"), customer("N2"))
    whole = dim
    for k, silver in enumerate((one, two)):
        as_of = DAY + dt.timedelta(days=k)
        run = history_store.apply_day(spark, root, silver, as_of, rows_per_file=20)
        whole = stage(scd2.apply_history(whole, silver, as_of).dimension, "whole")
    again = history_store.apply_day(spark, root, two, as_of, rows_per_file=20)
    assert again.rewritten == [] and again.version == run.version
    names = sorted(dim.columns)
    assert rows_of(snapshots.read(spark, again.version, history_store.TABLE).select(*names)) == rows_of(whole.select(*names))
    empty = history_store.apply_day(spark, root, one.limit(0), as_of)
    assert empty.opened == [] and empty.version == run.version
