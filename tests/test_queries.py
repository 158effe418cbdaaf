"""Every registered query against its SQL twin; the ones without a twin must return rows."""

from __future__ import annotations

import pytest
from compare import difference, oracle_connection
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()
# The corpus queries are tested in tests/llm, where they are there.
CORPUS = {name for name in QUERIES if name == "pipeline" or name.startswith("op")}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - CORPUS))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["id", "score", "next_id"]
