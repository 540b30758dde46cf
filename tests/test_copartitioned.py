"""Deliveries stored by client: no exchange on the client, and hot clients over many tasks."""

import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from creditloom.operators.spec import FeatureSpec, Segment, block, build_features
from creditloom.plans import instalments
from creditloom.sources import copartitioned
from creditloom.sources.copartitioned import open_stored, store
from creditloom.workload.analogue import credit_table
from creditloom.workload.registry import Tables


def exchanges(frame):
    """The keys of the exchanges of the plan, as text."""
    frame.collect()  # the final plan of adaptive execution
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    return [line.strip() for line in final.splitlines() if "Exchange" in line]


@pytest.fixture(autouse=True)
def no_broadcasts(spark):
    """As with tables too large to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def payments(spark):
    return credit_table(Tables(spark, SMALL), "installments_payments")


def test_instalment_features_without_an_exchange(spark, payments, tmp_path):
    stored = store(payments, str(tmp_path / "p"), "SK_ID_CURR", buckets=6)
    assert stored.hot is not None  # payments without a client
    got = instalments._of_buckets(stored.rows)
    assert exchanges(got) == []
    want = instalments.features(payments)
    rounded = lambda f: sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in f.collect()
    )
    assert str(rounded(instalments.stored_features(stored))) == str(rounded(want))


def test_joins_of_stored_tables_stay_in_place(spark, payments, tmp_path):
    """Rows with totals, and totals with totals, of two tables with the same buckets."""
    known = payments.where("SK_ID_CURR IS NOT NULL")
    loans = known.groupBy("SK_ID_CURR", "SK_ID_PREV").agg(F.count(F.lit(1)).alias("n"))
    one, other = (
        store(table, str(tmp_path / name), "SK_ID_CURR", buckets=5).rows
        for name, table in (("p", known), ("l", loans))
    )
    spec = FeatureSpec(("SK_ID_CURR",), (Segment("A_", (block("sum", "n"), block("nunique", "SK_ID_PREV"))),))
    total = build_features(other, spec)
    joined = one.groupBy("SK_ID_CURR").agg(F.count(F.lit(1)).alias("rows")).join(total, "SK_ID_CURR")
    assert exchanges(joined.hint("merge")) == []
    assert all(r.rows == r.A_n_SUM for r in joined.collect())
    assert exchanges(one.join(other.hint("merge"), "SK_ID_CURR").groupBy("SK_ID_CURR").count()) == []


def test_hot_clients_spread_over_tasks(spark, tmp_path):
    frame = spark.range(0, 40_000, 1, 8).selectExpr(
        "IF(id % 2 = 0, 7L, id % 100) AS SK_ID_CURR", "id AS SK_ID_PREV", "id % 3 AS x"
    )
    stored = store(frame, str(tmp_path / "h"), "SK_ID_CURR", buckets=4, hot_rows=1000)
    assert stored.hot.select("SK_ID_CURR").distinct().collect() == [(7,)]
    assert stored.rows.where("SK_ID_CURR = 7").isEmpty()
    parts = stored.hot.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 10_000
    count = lambda rows: rows.groupBy("SK_ID_CURR").agg(F.sum("x").alias("x"))
    got = {r.SK_ID_CURR: r.x for r in stored.derive(count).collect()}
    assert got == {r.SK_ID_CURR: r.x for r in count(frame).collect()}
    assert stored.everything().count() == 40_000


def test_a_bucket_is_one_file_and_a_repeat_replaces(spark, tmp_path):
    root = str(tmp_path / "r")
    for size in (500, 300):
        stored = store(spark.range(size).selectExpr("id AS k", "id AS `odd ``name`"), root, "k", buckets=4)
    folders = [d for d in os.listdir(root) if d.startswith(("buckets", "hot"))]
    assert len(folders) == 1 and stored.hot is None
    assert len([f for f in os.listdir(f"{root}/{folders[0]}") if f.startswith("part")]) == 4
    again = open_stored(spark, root)
    assert again.rows.count() == 300 and again.buckets == 4
    assert exchanges(again.rows.groupBy("k").count()) == []


def test_opened_by_another_session(spark, tmp_path):
    """The layout file alone is enough: a catalog that knows nothing registers the table anew."""
    root = str(tmp_path / "s")
    store(spark.range(100).selectExpr("id AS k", "id % 7 AS x"), root, "k", buckets=3)
    for table in spark.catalog.listTables():
        if table.name.startswith("stored_"):
            spark.sql(f"DROP TABLE {table.name}")
    opened = open_stored(spark, root)
    assert exchanges(opened.rows.groupBy("k").agg(F.sum("x"))) == []
    assert opened.rows.count() == 100


def test_empty_and_all_missing_keys(spark, tmp_path):
    empty = store(spark.range(0).selectExpr("id AS k", "id AS x"), str(tmp_path / "e"), "k", buckets=2)
    assert empty.rows.isEmpty() and empty.hot is None
    missing = spark.range(5).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS x")
    stored = store(missing, str(tmp_path / "m"), "k", buckets=2)
    assert stored.rows.isEmpty() and stored.hot.count() == 5
    assert copartitioned.HOT_KEY_ROWS > 1_000_000
