"""Every registered query against its DuckDB statement on the sf0.001 tables."""

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = con.sql(ORACLES[name]).df()
    r = compare(sp, dk)
    assert r["cols_ok"], r
    assert r["rows"][0] == r["rows"][1], r
    assert not r["bad"], r["bad"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.limit(5).count() > 0
