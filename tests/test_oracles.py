"""Every registered query against its reference SQL on the given tables."""

import pytest

import __spark_entry__ as contract
import compare
from surveyloom.plans import catalog


@pytest.fixture(scope="module")
def duck(data_dir):
    return compare.connect(data_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, data_dir, name):
    assert compare.spark_rows(spark, name, data_dir) == compare.oracle_rows(duck, name)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, data_dir, name):
    assert contract.queries()[name](spark, data_dir).count() > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["term"] for r in rows} >= {"intercept", "product_quality_score"}
