"""Every query with an SQL twin gives the rows DuckDB gives."""

import pytest

import __spark_entry__ as entry_points
import check


@pytest.fixture(scope="module")
def con(small):
    return check.connect(small)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, con, small, name):
    problem, _, _ = check.compare(spark, con, name, small)
    assert problem == ""


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
