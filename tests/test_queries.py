"""Every registered query, against its SQL equivalent where it has one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from oracle import compare, connect

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()
NON_EMPTY: dict[str, int] = {}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert compare(df, SQL[name], con) is None
    else:
        assert df.count() == NON_EMPTY.get(name, df.count()) > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [r.hour for r in rows] == list(range(24))


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
