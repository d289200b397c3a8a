"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as driver
from civicpanel.catalogue import ORACLES, QUERIES
from tests.oracle import DATA, compare, connect

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.queries()) >= set(QUERIES) and set(driver.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    problem = compare(spark, duck, QUERIES[name], ORACLES[name], FOLDER)
    assert problem is None, problem


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0
