"""Every registered batch and stream query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from ledgerguard.oracle_check import compare, duck
from ledgerguard.plans.queries import ORACLE, QUERIES
from ledgerguard.streaming.queries import STREAM_ORACLE, STREAM_QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_batch_query_matches_oracle(spark, con, name):
    assert compare(spark, con, SF_SMALL, name, QUERIES, ORACLE) is None


@pytest.mark.parametrize("name", sorted(STREAM_QUERIES))
def test_stream_query_matches_oracle(spark, con, name):
    assert compare(spark, con, SF_SMALL, name, STREAM_QUERIES, STREAM_ORACLE) is None


def test_contract_shapes(spark):
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert set(QUERIES) | set(STREAM_QUERIES) <= set(orc)
    assert E.entry(spark).count() > 0
