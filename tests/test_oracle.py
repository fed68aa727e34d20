"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
from daygrain.queries import oracle_sql, queries

QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    ours, theirs = oracle.schemas(df, con, SQL[name])
    assert ours == theirs
    assert oracle.spark_table(df) == oracle.sql_table(con, SQL[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
