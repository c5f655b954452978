import pytest

import __spark_entry__ as driver
from checks.compare import difference

from checks.catalog import all_queries
from checks.oracle import all_oracles

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r.vehicle_health for r in rows] == ["CRITICAL", "WARNING", "NORMAL"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, driver.SMALLEST, name, QUERIES[name], ORACLES[name]) is None
