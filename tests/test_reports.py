"""Every registered report against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

QUERIES, SQLS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, name, QUERIES[name], SQLS.get(name)) == []


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_sql_only_for_reports():
    assert set(SQLS) <= set(QUERIES)
