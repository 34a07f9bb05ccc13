"""Every query of the core against its SQL, and those without SQL for a stable schema."""

import pytest

from skeinwork.plans import catalog

from .oracle import check, connection


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, sf, con, name):
    check(con, catalog.SQL[name], catalog.QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - {"layer_metrics", "pseudo_diameter"}))
def test_without_sql(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
