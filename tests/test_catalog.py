"""Every catalogue query next to its SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as contract
from codetide.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, SF)
    assert ok, note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["_id", "event_id", "event_type", "k"] and rows.count() > 0
