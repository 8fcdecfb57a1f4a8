"""Every query beside its SQL twin on the smallest tables, and the driver contract."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver  # noqa: E402
import workload  # noqa: E402
from check_queries import compare, connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, SMALL).toPandas()
    verdict = compare(got, duck.sql(workload.oracle_sql()[name]).df())
    assert verdict.startswith("ok"), verdict


def test_contract(spark):
    assert set(workload.oracle_sql()) == set(workload.queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
