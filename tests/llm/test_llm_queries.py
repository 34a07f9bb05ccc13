"""The queries of the subpackage against their SQL."""

import pytest

from skeinwork.llm.queries import QUERIES
from skeinwork.llm.sql import SQL

from ..oracle import check, connection


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, con, name):
    check(con, SQL[name], QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns and df.count() >= 0
