from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopmart.session import build_session  # noqa: E402

HASH_KEY = "unit-test-key-which-is-long-enough-0123456789"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shopmart-tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df):
    """Rows as plain tuples in a stable order, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def only(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
