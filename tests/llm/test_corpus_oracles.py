"""Registered corpus queries against their SQL; the others against brute force in the tests beside."""

import compare
import pytest

import __spark_entry__ as contract
from surveyloom.llm import catalog


@pytest.fixture(scope="module")
def duck(data_dir):
    return compare.connect(data_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, data_dir, name):
    assert compare.spark_rows(spark, name, data_dir) == compare.oracle_rows(duck, name)


def test_all_operators_are_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert names == list(range(1, 14)) and set(catalog.QUERIES) | {"pipeline"} <= set(contract.queries())
