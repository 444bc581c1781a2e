"""Every bound query gives the rows of its SQL twin."""

import pytest

import __spark_entry__ as entry
from civicloom import queries as bound
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = bound.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_twin():
    assert sorted(SQL) == sorted(bound.queries())


@pytest.mark.parametrize("name", sorted(bound.queries()))
def test_query(spark, con, name):
    assert compare(bound.queries()[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    scores = [row["severity_score"] for row in entry.entry(spark).collect()]
    assert scores and scores == sorted(scores, reverse=True)
