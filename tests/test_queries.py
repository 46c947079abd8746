"""Every registered query against its SQL on the smallest driver data."""

import pytest

import __spark_entry__ as driver
from compare import differences, duck_connection
from growthlake.oracle import oracle_queries
from growthlake.registry import all_queries

SF = "/root/testdata/sf0.001"
# the text queries, where installed, are tested with their subpackage
QUERIES, SQL = all_queries(), oracle_queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["cohort", "accounts", "activated", "activation_rate"]
