"""Every query of the catalogue against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry_point
from strandline.plans.catalogue import QUERIES
from strandline.plans.catalogue_sql import ORACLE
from tests.conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)
pytestmark = pytest.mark.skipif(
    not Path(SF_SMALL).is_dir(), reason="the benchmark tables are not here"
)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(
            f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'"
        )
    yield connection
    connection.close()


def comparable(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])

    def shown(value: object) -> str:
        if value is None or value is pd.NaT:
            return "-"
        return f"{value:.9g}" if isinstance(value, float) else str(value)

    return sorted(tuple(shown(row[at]) for at in order) for row in data)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry_returns_rows(spark):
    assert not entry_point.entry(spark).isEmpty()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    found = QUERIES[name](spark, SF_SMALL)
    expected = oracle.sql(ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    got = comparable(found.columns, [tuple(r) for r in found.collect()])
    assert got == comparable(expected.columns, expected.fetchall())
