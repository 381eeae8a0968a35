"""Every registered query equals its DuckDB oracle on the sf0.001 fixtures."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from vartab.plans import oracles
from vartab.plans.compare import compare_query
from vartab.plans.queries import QUERIES

ORACLES = oracles.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare_query(spark, duck, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "Consequence_stop_gained" in df.columns


def test_entry_schema_is_stable(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() == b.count() > 0
