"""Every registered query against its DuckDB oracle on the smallest tables (the driver's gate runs sf0.01)."""

import pytest

import __spark_entry__ as entry_mod
from devmetrics.plans.catalog import QUERIES
from tests.oracle_check import compare
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:2] == ["timestamp_ns", "measurement"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(entry_mod.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    result = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert result.startswith("OK"), result
