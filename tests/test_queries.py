import pytest

from tarmac.checks import fixtures
from tarmac.checks.compare import connect, difference
from tarmac.checks.oracle import ORACLE
from tarmac.checks.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_expectation_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, sf, db, name):
    assert difference(spark, sf, name, db) is None


def test_flights_are_joined_once_for_lines_and_both_trainings(spark, sf, monkeypatch):
    read, table = [], fixtures.table
    monkeypatch.setattr(fixtures, "table", lambda spark, sf_dir, name: read.append(name) or table(spark, sf_dir, name))
    assert QUERIES["stream_model_switch"](spark, sf).where("same_prediction").count() > 0
    assert sorted(read) == ["customer", "nation", "orders"]
