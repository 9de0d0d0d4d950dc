"""Every registered query against its SQL on the smallest data."""

import pytest

from workload.check import connect, spark_rows, sql_rows
from workload.queries import REGISTRY
from workload.sql import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    assert spark_rows(REGISTRY[name](spark, SF)) == sql_rows(con, oracle_sql()[name])
