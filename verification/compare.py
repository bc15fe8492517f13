"""Compare a Spark result with its DuckDB oracle as multisets of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, float):
        return ("float", repr(value))
    return value


def compare(result: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Differences in words; an empty list means equal."""
    cursor = con.execute(sql)
    expected_columns = [c[0] for c in cursor.description]
    expected_types = dict((c[0], str(c[1])) for c in cursor.description)
    expected_rows = cursor.fetchall()
    if sorted(result.columns) != sorted(expected_columns):
        return [f"columns {sorted(result.columns)} != {sorted(expected_columns)}"]
    order = sorted(expected_columns)
    at = [expected_columns.index(c) for c in order]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in expected_rows)
    got = Counter(tuple(_plain(r[c]) for c in order) for r in result.collect())
    problems = []
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
    }
    for name, spark_type in result.dtypes:
        mine = names.get(spark_type, spark_type.upper())
        if mine.replace(" ", "") != expected_types[name].replace(" ", ""):
            problems.append(f"type of {name}: {spark_type} != {expected_types[name]}")
    if sum(want.values()) != sum(got.values()):
        problems.append(f"rows {sum(got.values())} != {sum(want.values())}")
    if want != got:
        missing = list((want - got).items())[:2]
        extra = list((got - want).items())[:2]
        problems.append(f"missing {missing} extra {extra} columns {order}")
    return problems
