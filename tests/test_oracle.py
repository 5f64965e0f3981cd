"""Every registered query against its SQL on the same tables.

The session runs in a zone of its own, so a result that depended on it would differ.
"""

import pytest

import __spark_entry__
import oracle
from tallyline.plans import registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, con):
    assert oracle.compare(QUERIES[name](spark, folder), con, SQL[name]) == ""
