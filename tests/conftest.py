import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def typed(spark, sf):
    """Typed flights, kept in memory for the tests."""
    from tarmac.checks.fixtures import flights_typed

    return flights_typed(spark, sf).persist()


@pytest.fixture(scope="session")
def trained(typed):
    from tarmac.plans.training import train

    return train(typed, sample=1.0, key="FLIGHT_ID")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_of
