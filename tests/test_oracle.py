"""Every registered query against its DuckDB oracle at sf0.001, compared the
way the driver does (row count, column names, order-insensitive hash)."""

from __future__ import annotations

import pytest
from compare import compare, duck
from conftest import SF_SMALL

import __spark_entry__ as E
from triad.plans import catalog

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_registered_with_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_schema_stable(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema
    assert a.count() == b.count() > 0
