"""Every registered query against its SQL text on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks import registry, sql
from checks.compare import connect, differences
from tests.conftest import SMALL

QUERIES = {name: query for name, query in contract.queries().items() if name in registry.queries()}
ORACLES = {name: text for name, text in contract.oracle_sql().items() if name in sql.oracles()}
SAMPLES = {"table_sample", "weighted_route_sample"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_but_the_random_ones_has_sql():
    assert set(QUERIES) - set(ORACLES) == SAMPLES
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_random_query_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
