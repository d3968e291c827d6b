"""Every registered query against its SQL on the small tables."""

import pytest
from compare import differences, second_engine
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from gustline.plans import oracles, queries as plans, reliability, reliability_oracles

QUERIES = {**plans.QUERIES, **reliability.QUERIES}
ORACLES = {**oracles.ORACLES, **reliability_oracles.ORACLES}


@pytest.fixture(scope="module")
def connection():
    return second_engine(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == []
