"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
import oracles
import registry
import verify

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    assert verify.compare(spark, con, name, SF).startswith("ok")


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
