"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as spark_entry
from marlstone.workload import oracle
from marlstone.workload.queries import QUERIES
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF, name) == ""


def test_entry(spark):
    rows = spark_entry.entry(spark)
    assert rows.columns[0] == "product_category" and rows.count() > 0
