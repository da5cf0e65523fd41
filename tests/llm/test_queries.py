import pytest

from millrace.llm.queries import QUERIES, SQL
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), sf_dir, name, QUERIES[name], SQL[name]) == []


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
