"""Every query against its SQL form in DuckDB, values compared exactly."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from tillwise.verify.queries import REGISTRY
from tillwise.verify.sql import statements

TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck(root):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or value != value:
        return "NULL"
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(pd.Timestamp(value)) if not isinstance(value, str) else value


def _lines(frame: pd.DataFrame) -> list[str]:
    ordered = frame[sorted(frame.columns)].astype(object)
    return sorted("|".join(map(_text, row)) for row in ordered.itertuples(index=False))


def test_every_query_has_sql():
    assert set(REGISTRY) == set(statements())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows(spark, root, duck, name):
    ours = REGISTRY[name](spark, root).toPandas()
    theirs = duck.execute(statements()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert _lines(ours) == _lines(theirs)
