"""Every registered query against its SQL, and the driver contract."""

import importlib

import pytest

from workload.compare import connect, difference
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, SF_DIR, name) is None


def test_driver_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    frame = entry.entry(spark)
    assert len(frame.columns) == 31 and frame.count() > 0
