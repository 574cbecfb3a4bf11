"""Oracle parity: every query with SQL equals DuckDB on the same parquet tables."""

import pytest

from conftest import SF_MID
from oracle_check import compare, duck_connection

from tessera.plans.registry import all_queries, all_sql

SQL = all_sql()
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_MID)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle_parity(spark, duck, name):
    ok, msg = compare(name, QUERIES[name](spark, SF_MID), duck, SQL[name])
    assert ok, msg
