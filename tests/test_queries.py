"""Every registered query against its SQL, on the smallest test tables."""

import __spark_entry__ as entry_points
import oracle
import pytest
from conftest import SMALL

from creditloom import workload

QUERIES = workload.callables()
STATEMENTS = workload.statements()


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SMALL)


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(STATEMENTS)
    assert len(QUERIES) >= 70
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(STATEMENTS) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert oracle.differences(QUERIES[name](spark, SMALL), connection, STATEMENTS[name]) == []


def test_the_comparison_notices_differences(spark, connection):
    frame = spark.read.parquet(f"{SMALL}/region.parquet")
    sql = "SELECT r_regionkey, r_name FROM region"
    assert oracle.differences(frame.select("r_regionkey", "r_name"), connection, sql) == []
    assert oracle.differences(frame.select("r_regionkey"), connection, sql)
    assert oracle.differences(frame.limit(3), connection, sql)
    assert oracle.differences(
        frame.selectExpr("r_regionkey + 1 AS r_regionkey", "r_name"), connection, sql
    )


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert len(frame.columns) == 235
    assert frame.count() > 0
