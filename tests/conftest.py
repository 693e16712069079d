from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from zonecast.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not os.path.isdir(SMALL):
        pytest.skip("shared tables are not available")
    return SMALL


def rows(df, *order):
    """Rows as tuples, sorted, nulls last."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda row: [(value is None, value if value is not None else 0) for value in row])
