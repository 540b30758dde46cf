"""One feature table for one date: read the deliveries, derive, write, export, publish."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditloom import plans
from creditloom.session import written
from creditloom.sources import sinks, snapshots, tables


@dataclass(frozen=True)
class Job:
    """Input tables in the order in which ``features`` takes them, and the columns it gives."""

    inputs: tuple[str, ...]
    features: Callable[..., DataFrame]
    columns: Sequence[str]
    keys: tuple[str, ...] = ("SK_ID_CURR",)


JOBS = {
    "application_peers": Job(
        ("application_train", "application_test"),
        plans.application_peers.features,
        plans.application_peers.COLUMNS,
        plans.application_peers.PEER_KEYS,
    ),
    "bureau": Job(("bureau", "bureau_balance"), plans.bureau.features, plans.bureau.COLUMNS),
    "credit_card": Job(
        ("credit_card_balance",), plans.credit_card.features, plans.credit_card.COLUMNS
    ),
    "pos_cash": Job(("pos_cash_balance",), plans.pos_cash.features, plans.pos_cash.COLUMNS),
    "instalments": Job(
        ("installments_payments",), plans.instalments.features, plans.instalments.COLUMNS
    ),
    "previous_applications": Job(
        ("previous_application", "installments_payments"),
        plans.previous_applications.features,
        plans.previous_applications.COLUMNS,
    ),
}


QUALITY = "table string, column string, rows long, rejected long"


def taken_in(
    spark: SparkSession, deliveries: str, table: str, run_date: str
) -> tuple[DataFrame, list[tuple]]:
    """A delivery parsed once into columns, and its quality: rows and rejected values per column.

    The values that do not parse are counted in the pass that stores the columns.
    """
    seen = Observation()
    rows = written(tables.read_run_csv(spark, deliveries, table, run_date, observed=seen))
    # without any file there is nothing to observe
    counts = seen.get if rows.columns and not rows.isEmpty() else {}
    found = [(table, c, counts.get("rows", 0), counts.get(c, 0)) for c in rows.columns]
    return rows, found


def run_job(
    spark: SparkSession, name: str, deliveries: str, out: str, run_date: str
) -> DataFrame:
    """Derive table ``name`` from the deliveries of a date; the rows as written.

    Writes the run to ``<out>/<name>/features``, exports it without header in column order to
    ``<out>/<name>/export/<date>``, and lays it over what is published by key in
    ``<out>/<name>/published``. What that changed since the snapshot before, which is all a loader
    has to take, goes to ``<out>/<name>/changes``, and ``<out>/<name>/quality`` says how many
    values of each input column did not parse. Running a date again replaces what it wrote.
    """
    job = JOBS[name]
    inputs = [taken_in(spark, deliveries, table, run_date) for table in job.inputs]
    root = f"{out}/{name}"
    quality = spark.createDataFrame([row for _, found in inputs for row in found], QUALITY)
    sinks.write_run(quality, f"{root}/quality", run_date)
    wide = job.features(*(rows for rows, _ in inputs)).select(*(f"`{c}`" for c in job.columns))
    sinks.write_run(wide, f"{root}/features", run_date)
    rows = tables.read_run(spark, f"{root}/features", run_date)
    sinks.export_csv(rows, f"{root}/export/{run_date}")
    versioned = rows.withColumn("run", F.lit(int(run_date)))
    published = f"{root}/published"
    sinks.publish(versioned, published, job.keys, "run", snapshot=run_date)
    earlier = [name for name in snapshots.snapshots(spark, published) if name < run_date]
    if earlier:
        fed = snapshots.changes(spark, published, earlier[-1], run_date)
        sinks.write_run(fed, f"{root}/changes", run_date)
    return rows
