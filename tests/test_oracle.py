"""Every query with SQL agrees with DuckDB: columns, types, rows, values."""

import pytest
from compare import compare, duck

from tallyward.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, con, name):
    assert compare(QUERIES[name](spark, data), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
