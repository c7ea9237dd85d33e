"""Every registered query against its SQL, and the contract's shape."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from catalog import oracles, queries
from tools.compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert queries.queries().keys() == oracles.oracle_sql().keys()
    assert queries.queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    verdict = compare(spark, con, sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["year_month", "neighbourhood_cleansed", "avg_price"]
    assert df.limit(1).count() == 1
