"""Every registered query against its SQL, and every query without SQL for
rows and a stable schema."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_sql_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    actual = entry.queries()[name](spark, SF).toArrow()
    expected = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert difference(actual, expected) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_returns_rows(spark, name):
    frame = entry.queries()[name](spark, SF)
    assert frame.schema == entry.queries()[name](spark, SF).schema
    assert frame.count() > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 30
