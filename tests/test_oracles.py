"""Every registered crawl query gives the rows of its SQL on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from crawlweave.plans.catalog import ORACLES as SQL
from crawlweave.plans.catalog import QUERIES
from tools.compare import canonical, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    result = con.execute(SQL[name])
    want = canonical(result.fetchall(), [d[0] for d in result.description])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_registered():
    assert QUERIES.items() <= queries().items() and SQL.items() <= oracle_sql().items()
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
