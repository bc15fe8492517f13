from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from brookledger.session import build_session  # noqa: E402

AS_OF = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "brookledger-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Bronze rows of an entity from dicts; columns left out are NULL."""
    from brookledger.fixed_values import LINEAGE_COLUMNS, SOURCE_COLUMNS

    def make(entity, *rows):
        columns = SOURCE_COLUMNS[entity] + LINEAGE_COLUMNS
        fields = ", ".join(
            f"{c} timestamp_ntz" if c == "_load_timestamp" else f"{c} string" for c in columns
        )
        defaults = {
            "_source_file": "f1", "_source_entity": entity, "_batch_id": "BATCH_1",
            "_load_timestamp": dt.datetime(2023, 1, 1),
        }
        data = [tuple({**defaults, **r}.get(c) for c in columns) for r in rows]
        return spark.createDataFrame(data, fields)

    return make


def rows_of(df):
    """Rows as a sorted list of tuples, NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def plan_of(df):
    return df._jdf.queryExecution().toString()


def executed_plan_of(df):
    """The plan after its adaptive changes; runs the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
