"""Writing feature tables: repeatable run-dated output, CSV export; keyed snapshots from their module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.sources.snapshots import merge_latest, publish, read_published
from creditloom.sources.tables import RUN_DATE

__all__ = ["export_csv", "merge_latest", "publish", "read_published", "write_run"]


def write_run(df: DataFrame, path: str, run_date: str) -> None:
    """Write one run; writing the same run again replaces it and leaves the other runs alone."""
    (
        df.withColumn(RUN_DATE, F.lit(run_date))
        .hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Write CSV without header; the column order is the contract with the reader.

    ``single_file`` sends the finished rows through one task, which writes them. Leave it off for
    tables that are not small.
    """
    if single_file:
        df = df.repartition(1)
    df.write.mode("overwrite").option("header", False).csv(path)
