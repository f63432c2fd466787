"""Queries that have a SQL twin give its rows."""

import pytest

from quire.llm.queries import queries
from quire.llm.sql import oracle_sql


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, duck, sf_dir, name):
    got = queries()[name](spark, sf_dir)
    want = duck.sql(oracle_sql()[name])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str) and got.columns == want.columns
