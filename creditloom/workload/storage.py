"""Queries: CSV scan, run-dated partitions, repeatable writes, export, keyed snapshots.

Each writes tables derived from the inputs to a scratch folder and returns what a reader sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from creditloom.session import scratch_folder, written
from creditloom.sources import sinks, snapshots, tables
from creditloom.workload.registry import Tables, query

CUSTOMER = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_mktsegment", StringType()),
        StructField("c_acctbal", DoubleType()),
    ]
)


@query("src_csv_scan", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def src_csv_scan(t: Tables) -> DataFrame:
    """Two deliveries in one folder, with their columns in different orders."""
    folder = scratch_folder(t.spark) + "/customer"
    backwards = [f"`{name}`" for name in reversed(t.customer.columns)]
    for part, columns in enumerate((["*"], backwards)):
        rows = t.customer.where(f"c_custkey % 2 = {part}").selectExpr(*columns)
        rows.write.mode("append").option("header", True).csv(folder)
    return tables.read_csv(t.spark, folder, CUSTOMER)


@query(
    "src_csv_infer",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus,
              CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR)
                   WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS mixed,
              o_orderkey * 4000000000 AS large
       FROM orders""",
)
def src_csv_infer(t: Tables) -> DataFrame:
    """Three deliveries of different columns in different orders; every type is found in the files."""
    folder = scratch_folder(t.spark) + "/orders"
    orders = t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_totalprice",
        "o_orderstatus",
        (F.col("o_orderkey") * F.lit(4_000_000_000)).alias("large"),
        F.col("o_custkey").alias("number"),
        "o_orderpriority",
    )
    common = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "large"]
    layouts = ([*common, "number AS mixed"], ["o_orderpriority AS mixed", *common[::-1]], common)
    for part, columns in enumerate(layouts):
        rows = orders.where(f"o_orderkey % 3 = {part}").selectExpr(*columns)
        rows.write.mode("append").option("header", True).csv(folder)
    found = tables.read_csv(t.spark, folder)
    return found.select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "mixed", "large"
    )


@query(
    "src_csv_rejected",
    """SELECT 'c_acctbal' AS column, count(*) AS rows,
              count(*) FILTER (WHERE c_custkey % 5 = 0) AS rejected FROM customer
       UNION ALL SELECT 'c_custkey', count(*), count(*) FILTER (WHERE c_custkey % 7 = 0) FROM customer
       UNION ALL SELECT 'c_mktsegment', count(*), 0 FROM customer""",
)
def src_csv_rejected(t: Tables) -> DataFrame:
    """How many values of a delivery do not parse, counted while it is stored."""
    folder = scratch_folder(t.spark) + "/customer"
    spoilt = t.customer.select(
        F.when(F.col("c_custkey") % 7 == 0, "no number")
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("c_custkey"),
        "c_mktsegment",
        F.when(F.col("c_custkey") % 5 == 0, "1,5")
        .when(F.col("c_custkey") % 5 == 1, None)
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("c_acctbal"),
    )
    spoilt.write.option("header", True).csv(folder)
    seen = Observation()
    written(tables.read_csv(t.spark, folder, CUSTOMER, observed=seen))
    rows = [(name, seen.get["rows"], seen.get[name]) for name in CUSTOMER.names]
    return t.spark.createDataFrame(rows, "column string, rows long, rejected long")


@query(
    "src_run_date_partition",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998",
)
def src_run_date_partition(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark) + "/orders"
    dated = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.concat(F.year("o_orderdate").cast("string"), F.lit("1231")).alias(tables.RUN_DATE),
    )
    balanced = dated.hint("rebalance", tables.RUN_DATE)
    balanced.write.mode("overwrite").partitionBy(tables.RUN_DATE).parquet(folder)
    return tables.read_run(t.spark, folder, "19981231")


@query(
    "sink_csv_export",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c1, o_orderpriority AS _c2 "
    "FROM orders",
)
def sink_csv_export(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark) + "/export"
    sinks.export_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), folder)
    return t.spark.read.option("header", False).csv(folder)


@query(
    "sink_partition_overwrite",
    """SELECT o_orderkey, o_totalprice, '20010131' AS run_date FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, o_totalprice, '20010228' FROM orders""",
)
def sink_partition_overwrite(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark) + "/features"
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    first, second = rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'")
    sinks.write_run(first.drop("o_orderstatus"), folder, "20010131")
    sinks.write_run(rows.drop("o_orderstatus"), folder, "20010228")
    sinks.write_run(second.drop("o_orderstatus"), folder, "20010131")  # the repeated run
    return t.spark.read.parquet(folder).withColumn(
        tables.RUN_DATE, F.col(tables.RUN_DATE).cast("string")
    )


@query(
    "sink_keyed_upsert",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END
              AS c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM customer
       UNION ALL SELECT s_suppkey + 1000000000, s_acctbal, 2 FROM supplier""",
)
def sink_keyed_upsert(t: Tables) -> DataFrame:
    root = scratch_folder(t.spark) + "/published"
    clients = t.customer.select("c_custkey", "c_acctbal")
    # the first batch has keys twice, with an older version
    older = clients.withColumn("c_acctbal", F.lit(0.0)).withColumn("version", F.lit(0))
    first = clients.withColumn("version", F.lit(1)).unionByName(older)
    changed = clients.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    added = t.supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    second = changed.unionByName(added).withColumn("version", F.lit(2))
    sinks.publish(first, root, ["c_custkey"], "version", snapshot="a")
    sinks.publish(second, root, ["c_custkey"], "version", snapshot="b")
    return sinks.read_published(t.spark, root)


@query(
    "sink_change_feed",
    """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
                  AS o_totalprice,
              CASE WHEN o_orderkey % 11 = 0 THEN 'inserted' ELSE 'changed' END AS change
       FROM orders WHERE o_orderkey % 13 <> 5 AND (o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)
       UNION ALL SELECT o_orderkey, NULL, NULL, 'removed' FROM orders
       WHERE o_orderkey % 13 = 5 AND o_orderkey % 11 <> 0""",
)
def sink_change_feed(t: Tables) -> DataFrame:
    """Two whole deliveries of the orders; what a loader has to take of the second."""
    root = scratch_folder(t.spark) + "/published"
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)
    first = orders.where("o_orderkey % 11 <> 0").withColumn("run", F.lit(1))
    second = (
        orders.where("o_orderkey % 13 <> 5")
        .withColumn("o_totalprice", F.col("o_totalprice") + raised)
        .withColumn("run", F.lit(2))
    )
    snapshots.publish(first, root, ["o_orderkey"], "run", snapshot="1", full=True)
    snapshots.publish(second, root, ["o_orderkey"], "run", snapshot="2", full=True)
    return snapshots.changes(t.spark, root, "1", "2").drop("run")
