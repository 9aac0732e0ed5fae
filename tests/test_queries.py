"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from workloads.oracle import ORACLE
from workloads.queries import QUERIES
from tools.check_oracle import compare, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return tables(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= ORACLE.keys()


def test_entry_gives_all_customers_and_the_unknown_one(spark):
    assert contract.entry(spark).count() == 151


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    assert compare(spark, oracle, name, SF) == []
