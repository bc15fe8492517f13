"""CSV records from many splits: equal to the one-task reader, line numbers, load results."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from brookledger.fixed_values import SOURCE_COLUMNS
from brookledger.sources import bronze, csv_records, landing

ENTITY = "accounts"
NAMES = SOURCE_COLUMNS[ENTITY]


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes and blocks of four lines."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def extract(rows):
    return "\n".join([",".join(NAMES), *(",".join(r) for r in rows)]) + "\n"


def awkward(n, seed):
    draw = random.Random(seed)
    values = ["plain", "", " blanks ", quoted("a,b"), quoted('he said "x"'), quoted("two\nlines"), quoted("\n\nempty lines, too\n"), quoted(""), quoted('"\n"')]
    return [[f"A{k}", *(draw.choice(values) for _ in NAMES[1:])] for k in range(n)]


def test_same_rows_as_the_one_task_reader(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(csv_records, "BLOCK_LINES_BITS", 2)
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_text(extract(awkward(40, k)))
    found = csv_records.parsed(csv_records.records(spark, str(tmp_path)), ENTITY)
    one_task = bronze.read_extract(spark, str(tmp_path), ENTITY, multi_line=True)
    assert csv_records.physical_lines(spark, str(tmp_path)).select("file", "start").distinct().count() > 20
    assert rows_of(found.select(*NAMES, bronze.BAD_RECORD)) == rows_of(one_task.select(*NAMES, bronze.BAD_RECORD))
    assert found.count() == 120


def test_line_numbers_of_records(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(csv_records, "BLOCK_LINES_BITS", 2)
    text = extract(awkward(60, 9))
    (tmp_path / "x.csv").write_text(text)
    begins, line, inside = [], 1, False
    for row in text.split("\n")[:-1]:
        if not inside and row.strip():
            begins.append(line)
        inside ^= row.count('"') % 2 == 1
        line += 1
    found = csv_records.records(spark, str(tmp_path)).select("line").collect()
    assert sorted(r.line for r in found) == begins


def test_load_results_name_the_first_error(spark, tmp_path, small_splits):
    good = [f"A{k}" for k in range(len(NAMES))]
    broken = [*good[:3], quoted("two\nlines"), *good[4:]]
    (tmp_path / "good.csv").write_text(extract([good, broken]))
    (tmp_path / "short.csv").write_text(extract([good, broken, good[:5], good, good[:2]]))
    (tmp_path / "a b+c%.csv").write_text(extract([good]))
    (tmp_path / "long.csv").write_text(extract([[*good, "more", "x"]]))
    (tmp_path / "header.csv").write_text(extract([]))
    (tmp_path / "empty.csv").write_text("")  # no listing has it
    (tmp_path / "crlf.csv").write_text(extract([good, good]).replace("\n", "\r\n"))
    rows = csv_records.parsed(csv_records.records(spark, str(tmp_path)), ENTITY)
    results = csv_records.load_results(landing.listing(spark, str(tmp_path)), rows, ENTITY)
    found = {r["path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in results.collect()}
    n = len(NAMES)
    assert found == {
        "good.csv": ("LOADED", 2, 2, 0, None, None, None, None),
        "crlf.csv": ("LOADED", 2, 2, 0, None, None, None, None),
        "a b+c%.csv": ("LOADED", 1, 1, 0, None, None, None, None),
        "header.csv": ("LOADED", 0, 0, 0, None, None, None, None),
        "short.csv": ("PARTIALLY_LOADED", 5, 3, 2, f"Record has 5 columns, the table has {n}", 5, 6, NAMES[5]),
        "long.csv": ("LOAD_FAILED", 1, 0, 1, f"Record has {n + 2} columns, the table has {n}", 2, n + 1, None),
    }
    assert {r[-1] for r in rows.where(F.col("path").endswith("crlf.csv")).select(*NAMES).collect()} == {good[-1]}


def test_a_quote_left_open_loses_no_line(spark, tmp_path, small_splits):
    good = [f"A{k}" for k in range(len(NAMES))]
    (tmp_path / "open.csv").write_text(extract([good, ['"never closed', *good[1:]], *[good] * 30]))
    rows = csv_records.parsed(csv_records.records(spark, str(tmp_path), max_lines=10), ENTITY).collect()
    assert len(rows) == 32 and sum(r[bronze.BAD_RECORD] is None for r in rows) == 1
    assert sorted(r.line for r in rows) == list(range(2, 34))
