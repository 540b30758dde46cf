"""Queries: the ``events`` table replayed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import scratch_folder
from creditloom.streaming import submissions
from creditloom.workload.registry import Tables, query


def _events(t: Tables) -> DataFrame:
    return submissions.from_files(
        t.spark, t.folder, t.events.schema, pattern="events.parquet"
    )


@query("stream_batch_count", "SELECT count(*) AS records FROM events")
def stream_batch_count(t: Tables) -> DataFrame:
    """The counts written per micro-batch, added up: where batches end is up to the source."""
    scratch = scratch_folder(t.spark)
    submissions.run_until_drained(
        submissions.batch_counts(_events(t), f"{scratch}/out", f"{scratch}/state")
    )
    return t.spark.read.parquet(f"{scratch}/out").agg(F.sum("records").alias("records"))


@query(
    "stream_tumbling_count",
    """SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start,
              time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
              count(*) AS records FROM events GROUP BY 1, 2""",
)
def stream_tumbling_count(t: Tables) -> DataFrame:
    scratch = scratch_folder(t.spark)
    counts = submissions.tumbling_counts(_events(t), "ts", width="5 seconds")
    submissions.run_until_drained(
        submissions.to_batches(counts, f"{scratch}/out", f"{scratch}/state", mode="update")
    )
    latest = submissions.latest_per_window(t.spark, f"{scratch}/out")
    return latest.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "records",
    )


@query("stream_total_count", "SELECT count(*) AS records FROM events")
def stream_total_count(t: Tables) -> DataFrame:
    scratch = scratch_folder(t.spark)
    total = submissions.running_total(_events(t))
    submissions.run_until_drained(
        submissions.to_batches(total, f"{scratch}/out", f"{scratch}/state", mode="complete")
    )
    written = t.spark.read.parquet(f"{scratch}/out")
    return written.agg(F.max_by("records", "batch_id").alias("records"))


@query(
    "stream_kv_sink",
    "SELECT 'application_submit' AS key, CAST(value AS VARCHAR) AS value FROM events",
)
def stream_kv_sink(t: Tables) -> DataFrame:
    """Every event emitted as a message, through an append-mode file sink."""
    scratch = scratch_folder(t.spark)
    messages = submissions.as_messages(_events(t), "application_submit", "value")
    writer = (
        messages.writeStream.format("parquet")
        .option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/state")
    )
    submissions.run_until_drained(writer)
    return t.spark.read.parquet(f"{scratch}/out")


@query(
    "stream_submission_counter",
    "SELECT 'application_submit' AS key, count(*) AS submitted FROM events",
)
def stream_submission_counter(t: Tables) -> DataFrame:
    """Counts of batches as messages; their values, added up, do not depend on the batches."""
    scratch = scratch_folder(t.spark)
    writer = submissions.submission_counter(
        _events(t),
        "application_submit",
        submissions.message_files(f"{scratch}/out"),
        f"{scratch}/state",
    )
    submissions.run_until_drained(writer)
    messages = t.spark.read.parquet(f"{scratch}/out")
    return messages.groupBy("key").agg(F.sum(F.col("value").cast("bigint")).alias("submitted"))


@query(
    "stream_restarted_counter",
    "SELECT 'application_submit' AS key, count(*) AS submitted FROM events",
)
def stream_restarted_counter(t: Tables) -> DataFrame:
    """The counter stopped and restarted twice, with half of the events delivered again in between."""
    scratch = scratch_folder(t.spark)
    inbox, halves = f"{scratch}/in", (t.events.where(f"event_id % 2 = {part}") for part in (0, 1))
    first, second = halves

    def restart() -> None:
        events = submissions.from_files(t.spark, inbox, t.events.schema, files_per_batch=1)
        counted = submissions.distinct_events(events, "event_id", "ts", lateness="400 days")
        writer = submissions.submission_counter(
            counted,
            "application_submit",
            submissions.message_files(f"{scratch}/out"),
            f"{scratch}/state",
        )
        submissions.run_until_drained(writer)

    for delivery in (first, first, second):
        delivery.write.mode("append").parquet(inbox)
        restart()
    messages = t.spark.read.parquet(f"{scratch}/out")
    return messages.groupBy("key").agg(F.sum(F.col("value").cast("bigint")).alias("submitted"))
