"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import connect, differences

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(queries())
    without = {name for name in set(queries()) - set(SQL) if not name.startswith("op") and name != "pipeline"}
    assert not without


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert not differences(spark, duck, queries()[name], SQL[name], sf_dir)


def test_entry(spark):
    assert entry(spark).count() == 15
