"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tidemerge.queries import ORACLES, QUERIES

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, folder, name):
    assert compare(spark, con, folder, name) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)
    assert set(NAMES) <= set(contract.queries()) and set(NAMES) <= set(contract.oracle_sql())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 100 and [r.position for r in rows] == list(range(1, 101))
    days = [r.metric_date for r in rows]
    assert days == sorted(days, reverse=True)
