"""Every registered query against its SQL in an independent engine, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import FLAGSHIP_DIR, entry
from marketstrata.showcase import ORACLE, QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FLAGSHIP_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FLAGSHIP_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    value = value.item() if hasattr(value, "item") else value
    return float(value) if isinstance(value, int) else value


def _rows(frame):
    names = sorted(frame.columns)
    rows = [tuple(_plain(v) for v in row) for row in frame[names].itertuples(index=False, name=None)]
    return names, sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    found = _rows(QUERIES[name](spark, FLAGSHIP_DIR).toPandas())
    assert found == _rows(duck.sql(ORACLE[name]).df())
    assert found[1] or name in ("run_duration_check", "cap_reconciliation")


def test_entry(spark):
    assert entry(spark).count() == 1
