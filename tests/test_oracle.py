"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from stationlake.plans import oracle, queries
from tests.oracle_compare import compare, duck_connect

from tests.conftest import SF_SMALL

NAMES = sorted(queries.queries())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(NAMES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_temperature" in df.columns
