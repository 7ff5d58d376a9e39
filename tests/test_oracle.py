"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from routelytics import catalog
from scripts.check_oracle import compare

from conftest import SF_TINY

NAMES = sorted(catalog.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_tiny, name):
    ok, msg, _, _ = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF_TINY, duck_tiny)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "path_text" in df.columns
