"""Every registered query against its SQL oracle, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from checks import oracles, registry
from checks.compare import mismatch, open_oracle

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, oracle, name):
    assert mismatch(spark, oracle, name, SF_DIR) is None


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(entry_module.queries()) and set(oracles.oracle_sql()) <= set(entry_module.oracle_sql())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [r["venue_type"] for r in rows] == ["neutral", "non_neutral", "unknown"]
