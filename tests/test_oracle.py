"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from authwatch import catalog
from compare import connect, difference

QUERIES, ORACLES = {name: driver.queries()[name] for name in catalog.QUERIES}, driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 30
