from __future__ import annotations

import pytest

from cotrend import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "cotrend-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tools(spark):
    from cotrend import default_catalogue

    return default_catalogue(spark)


def rows(df):
    """Rows as a sorted list of tuples, NULL first."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, v) for v in row])


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def final_plan(df) -> str:
    """The plan that adaptive execution ended with."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
