from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from touchline.plans.oracles import ORACLES
from touchline.plans.registry import QUERIES

SF_DIR = os.environ.get("TOUCHLINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 10
