from __future__ import annotations

import pytest

from strandline.session import build_session

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df) -> list[tuple]:
    """All rows in one comparable order."""
    return sorted(
        (tuple(r) for r in df.collect()),
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
