"""Every registered query, against its SQL on DuckDB where it has one."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "value" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    if name in SQL:
        assert difference(df, duck, SQL[name]) is None
    else:
        assert df.columns and df.count() >= 0
