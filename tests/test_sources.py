from __future__ import annotations

import datetime as dt

import pytest
from conftest import AS_OF, rows_of
from pyspark.sql import functions as F

from brookledger.fixed_values import SOURCE_COLUMNS
from brookledger.plans import verify
from brookledger.sources import bronze, landing
from brookledger.sources.tables import add_missing_columns, broadcast_if_small, shared_folder
from brookledger.streaming.incremental import ingest_new_files

DAY = dt.date(2024, 1, 5)
HEADER = ",".join(SOURCE_COLUMNS["fraud_flags"])


def line(flag_id, reason="r", **other):
    values = {"flag_id": flag_id, "transaction_id": "T", "flag_reason": reason, **other}
    return ",".join(values.get(c, "") for c in SOURCE_COLUMNS["fraud_flags"])


def put(root, name, *lines, day=DAY, entity="fraud_flags"):
    from pathlib import Path

    folder = Path(landing.day_folder(str(root), entity, day))
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return path


def load(spark, root, target, as_of=AS_OF, **options):
    parsed = bronze.read_extract(spark, landing.entity_folder(str(root), "fraud_flags"), "fraud_flags", **options)
    bronze.store(bronze.to_bronze(parsed, "fraud_flags", as_of), str(target))


def test_late_files_and_forced_reloads_share_one_table(spark, tmp_path):
    import os

    source = landing.entity_folder(str(tmp_path), "fraud_flags")
    target, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    put(tmp_path, "a.csv", line("F1"))
    ingest_new_files(spark, source, "fraud_flags", target, progress, dt.datetime(2024, 1, 1))
    late = put(tmp_path, "late.csv", line("F2"))
    month_ago = late.stat().st_mtime - 30 * 86400
    os.utime(late, (month_ago, month_ago))
    put(tmp_path, "b.csv", line("F3"))
    ingest_new_files(spark, source, "fraud_flags", target, progress, dt.datetime(2024, 1, 2))
    load(spark, tmp_path, target, as_of=dt.datetime(2024, 1, 3))
    load(spark, tmp_path, target, as_of=dt.datetime(2024, 1, 3))
    found = sorted((r._batch_id[-1], r.flag_id) for r in bronze.rows(spark, target, "fraud_flags").collect())
    assert found == [("1", "F1"), ("2", "F2"), ("2", "F3")] + [("3", f) for f in ("F1", "F1", "F2", "F2", "F3", "F3")]


def test_a_retried_micro_batch_replaces_what_it_wrote(spark, raw, tmp_path):
    rows = raw("fraud_flags", {"flag_id": "F1"}).withColumn(bronze.BAD_RECORD, F.lit(None).cast("string"))
    rows = rows.withColumn(bronze.QUARANTINED, F.lit(False))
    for _ in range(2):
        bronze.store_load(rows, str(tmp_path), "stream-0")
    bronze.store_load(rows, str(tmp_path), "stream-1")
    assert bronze.rows(spark, str(tmp_path), "fraud_flags").count() == 2


def test_ineligible_files_are_not_loaded(spark, tmp_path):
    put(tmp_path, "a.csv", line("F1"))
    put(tmp_path, "b.txt", line("F2"))
    put(tmp_path, "c.json", '{"flag_id": "F3"}')
    put(tmp_path, "big.csv", *[line(f"F9{k}", "x" * 200) for k in range(6000)])
    source = landing.entity_folder(str(tmp_path), "fraud_flags")
    ingest_new_files(spark, source, "fraud_flags", str(tmp_path / "one"), str(tmp_path / "p"), AS_OF, max_mb=1)
    load(spark, tmp_path, tmp_path / "two", max_mb=1)
    for table in ("one", "two"):
        assert [r.flag_id for r in bronze.rows(spark, str(tmp_path / table), "fraud_flags").collect()] == ["F1"]
        assert bronze.quarantine(spark, str(tmp_path / table), "fraud_flags").count() == 0
    verdicts = {r.path.rsplit("/", 1)[1]: r.reason for r in landing.eligibility(landing.listing(spark, source), max_mb=1).collect()}
    assert verdicts == {"a.csv": None, "b.txt": "Invalid file type", "c.json": None, "big.csv": "File too large"}


def test_null_tokens_quotes_and_lineage(spark, tmp_path):
    path = put(
        tmp_path, "a.csv", line("F1", "NULL"), line("F2", "null"), line("F3", "None"),
        line("F4", ""), line("F5", '"say ""hi"", ok"'), line("F6", " none "), line("F7", '""'),
    )
    load(spark, tmp_path, tmp_path / "bronze")
    rows = {r.flag_id: r for r in bronze.rows(spark, str(tmp_path / "bronze"), "fraud_flags").collect()}
    reasons = {k: r.flag_reason for k, r in rows.items()}
    assert reasons == {"F1": None, "F2": None, "F3": None, "F4": None,
                       "F5": 'say "hi", ok', "F6": " none ", "F7": None}
    row = rows["F5"]
    assert row._source_file.endswith(path.name) and row._source_entity == "fraud_flags"
    assert (row._batch_id, row._load_timestamp) == ("BATCH_20240101", AS_OF)


def test_short_and_long_rows_are_quarantined_whole(spark, tmp_path):
    put(tmp_path, "a.csv", line("F1"), "F2,T", line("F3") + ",more,fields")
    load(spark, tmp_path, tmp_path / "bronze")
    target = str(tmp_path / "bronze")
    assert [r.flag_id for r in bronze.rows(spark, target, "fraud_flags").collect()] == ["F1"]
    assert bronze.rows(spark, target, "fraud_flags").select("flag_id").count() == 1
    kept = sorted(r.record for r in bronze.quarantine(spark, target, "fraud_flags").collect())
    assert kept == sorted(["F2,T", line("F3") + ",more,fields"])


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    put(tmp_path, "a.csv", line("F1", '"two\nlines"'))
    load(spark, tmp_path, tmp_path / "bronze", multi_line=True)
    (row,) = bronze.rows(spark, str(tmp_path / "bronze"), "fraud_flags").collect()
    assert row.flag_reason == "two\nlines"


def test_one_landing_day_reads_its_folder_only(spark, tmp_path):
    put(tmp_path, "a.csv", line("F1"))
    put(tmp_path, "a.csv", line("F2"), day=dt.date(2024, 11, 12))
    parsed = bronze.read_extract(
        spark, landing.entity_folder(str(tmp_path), "fraud_flags"), "fraud_flags",
        day=dt.date(2024, 11, 12),
    )
    assert [r.flag_id for r in parsed.collect()] == ["F2"]
    assert len(parsed.inputFiles()) == 1


def test_one_batch_prunes_the_others(spark, tmp_path):
    put(tmp_path, "a.csv", line("F1"), "short")
    target = tmp_path / "bronze"
    for day in (1, 2):
        load(spark, tmp_path, target, as_of=dt.datetime(2024, 1, day))
    batch = bronze.rows(spark, str(target), "fraud_flags", batch_id="BATCH_20240102")
    assert [(r.flag_id, r._batch_id) for r in batch.collect()] == [("F1", "BATCH_20240102")]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan and "PushedFilters: []" in plan


def test_landing_folders_have_two_digit_parts(spark, raw, tmp_path):
    landing.land_csv(raw("fraud_flags", {"flag_id": " F"}), str(tmp_path), "fraud_flags", DAY)
    folder = landing.day_folder(str(tmp_path), "fraud_flags", DAY)
    assert folder.endswith("raw/fraud_flags/year=2024/month=01/day=05")
    back = bronze.read_extract(spark, folder, "fraud_flags").select("flag_id", "reviewed_at")
    assert rows_of(back) == [(" F", None)]


def test_each_file_is_loaded_once(spark, tmp_path):
    source = landing.entity_folder(str(tmp_path), "fraud_flags")
    target, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

    def run(day):
        ingest_new_files(spark, source, "fraud_flags", target, progress, dt.datetime(2024, 1, day),
                         files_per_trigger=1)
        return bronze.rows(spark, target, "fraud_flags")

    put(tmp_path, "a.csv", line("F1"), "F2,short")
    put(tmp_path, "b.csv", line("F3"))
    assert run(1).count() == 2
    assert run(2).count() == 2
    put(tmp_path, "c.csv", line("F4"), day=dt.date(2024, 1, 6))
    after = run(3)
    assert {(r.flag_id, r._batch_id) for r in after.collect()} == {
        ("F1", "BATCH_20240101"), ("F3", "BATCH_20240101"), ("F4", "BATCH_20240103")}
    assert bronze.quarantine(spark, target, "fraud_flags").count() == 1
    assert {r.records_loaded for r in verify.batches(after).collect()} == {1, 2}


def test_eligibility_and_manifest(spark, tmp_path):
    import hashlib

    good = put(tmp_path, "a.csv", line("F1"))
    put(tmp_path, "b.xlsx", "x")
    files = landing.eligibility(landing.listing(spark, str(tmp_path)))
    assert {(r.path[-6:], r.is_valid, r.reason) for r in files.collect()} == {
        ("/a.csv", True, None), ("b.xlsx", False, "Invalid file type")}
    rows = {r.status: r for r in landing.manifest(spark, str(tmp_path), AS_OF).collect()}
    assert rows["SUCCESS"].checksum_md5 == hashlib.md5(good.read_bytes()).hexdigest()
    assert rows["SUCCESS"].entity == "fraud_flags" and rows["FAILED"].checksum_md5 is None
    total = landing.manifest_totals(landing.manifest(spark, str(tmp_path), AS_OF)).first()
    assert (total.total_files, total.successful, total.failed) == (2, 1, 1)


def test_size_limit(spark):
    limit = 500 * 1024 * 1024
    files = spark.createDataFrame(
        [("x/a.csv", "e", limit), ("x/b.csv", "e", limit + 1)], "path string, entity string, length long"
    )
    assert {(r.path, r.reason) for r in landing.eligibility(files).collect()} == {
        ("x/a.csv", None), ("x/b.csv", "File too large")}


def test_reconciliation_states(spark):
    schema = "path string, entity string, checksum_md5 string"
    promised = spark.createDataFrame([("a", "e", "1"), ("b", "e", "2"), ("c", "e", "3")], schema)
    found = spark.createDataFrame([("a", "e", "1"), ("b", "e", "9"), ("d", "f", "4")], schema)
    states = {(r.path, r.entity, r.state) for r in landing.reconcile(promised, found).collect()}
    assert states == {("a", "e", "OK"), ("b", "e", "CHANGED"), ("c", "e", "MISSING"),
                      ("d", "f", "UNEXPECTED")}


def test_missing_entities(spark):
    files = spark.createDataFrame([("a", "customers")], "path string, entity string")
    assert sorted(r.entity for r in landing.missing_entities(files).collect()) == [
        "accounts", "fraud_flags", "transactions"]


def test_broadcast_only_below_the_counted_bound(spark):
    small = spark.range(5)
    assert "strategy=broadcast" in broadcast_if_small(small, 5)._jdf.queryExecution().toString()
    assert "strategy=broadcast" not in broadcast_if_small(small, 4)._jdf.queryExecution().toString()


def test_columns_are_added_only_where_missing(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1,)], "a int")
    grown = add_missing_columns(df, {"a": (T.IntegerType(), 9), "b": (T.StringType(), "x")})
    assert rows_of(grown) == [(1, "x")]


class FakeSession:
    """Just what ``shared_folder`` asks a session for."""

    def __init__(self, folder, master):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark).startswith(named)
    assert shared_folder(FakeSession("s3a://shared/x", "yarn")) == "s3a://shared/x/brookledger/app"


def test_without_a_shared_folder_nothing_is_staged(monkeypatch):
    from brookledger.sources import tables

    monkeypatch.setattr(tables, "_own_folder", [])
    for master in ("local[4]", "yarn"):
        with pytest.raises(ValueError):
            shared_folder(FakeSession(None, master))
    tables.use_folder("/own")
    assert shared_folder(FakeSession(None, "local[4]")) == "/own/brookledger/app"
    assert shared_folder(FakeSession("/named", "yarn")) == "/named/brookledger/app"
