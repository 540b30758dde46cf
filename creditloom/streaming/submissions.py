"""Counting submitted applications on a stream, and emitting the counts as messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

TRIGGER = "5 seconds"


# --- sources --------------------------------------------------------------------------------


def from_kafka(
    spark: SparkSession, servers: str, topic: str, *, start: str = "latest"
) -> DataFrame:
    """Records of a topic as text key and value, with their event time ``ts``.

    Needs the Kafka connector package on the classpath. Offsets are kept in the checkpoint of the
    query, not committed to the broker.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("ts"),
        )
    )


def from_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    *,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream, new files as they arrive."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


# --- counts ---------------------------------------------------------------------------------


def distinct_events(
    stream: DataFrame, key: str, time: str, *, lateness: str = "1 hour"
) -> DataFrame:
    """Each event once, however often it is delivered; events without a key by their whole content.

    Keys are held in the query's state store, so a restart from its checkpoint knows them. A key is
    forgotten once the watermark is ``lateness`` past its event: a delivery has to be repeated
    within that, and events that arrive later than that are dropped.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in stream.columns)))
    known = F.coalesce(
        F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.concat(F.lit("?"), content)
    )
    return (
        timed.withColumn("__event", known).dropDuplicatesWithinWatermark(["__event"]).drop("__event")
    )



def tumbling_counts(
    stream: DataFrame, time: str, *, width: str = TRIGGER, lateness: str = "1 minute"
) -> DataFrame:
    """Records per event-time window; state older than the watermark is dropped."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return (
        timed.groupBy(F.window(time, width).alias("window"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "records",
        )
    )


def running_total(stream: DataFrame) -> DataFrame:
    """Number of records since the query started."""
    return stream.groupBy().agg(F.count(F.lit(1)).alias("records"))


def as_messages(df: DataFrame, key: str, value: str) -> DataFrame:
    """One message per row: a fixed key and the text of one column."""
    return df.select(F.lit(key).alias("key"), F.col(value).cast("string").alias("value"))


# --- sinks ----------------------------------------------------------------------------------


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=TRIGGER)
    )


def to_batches(df: DataFrame, folder: str, checkpoint: str, *, mode: str) -> DataStreamWriter:
    """Write the output of every micro-batch to ``<folder>/batch_id=<n>``.

    A batch that is repeated after a failure overwrites its own folder only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    )


def batch_counts(stream: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Write one row with the record count per micro-batch; an empty batch writes no row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("records")).where("records > 0")
        counted.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def submission_counter(
    stream: DataFrame,
    key: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: str = TRIGGER,
) -> DataStreamWriter:
    """Every ``trigger``, one message with a fixed key and the number of records as text.

    ``write`` gets the message of a batch and the batch's number, which is the same when a batch is
    repeated after a failure. A batch without records sends nothing.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("records")).where("records > 0")
        write(as_messages(counted, key, "records"), batch_id)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .foreachBatch(send)
    )


def message_files(folder: str) -> Callable[[DataFrame, int], None]:
    """Messages as Parquet files; a repeated batch replaces its own."""
    return lambda messages, batch_id: messages.write.mode("overwrite").parquet(
        f"{folder}/batch_id={batch_id}"
    )


def message_topic(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Messages to a Kafka topic, at least once. Needs the Kafka connector package."""
    return lambda messages, batch_id: (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def latest_per_window(spark: SparkSession, folder: str) -> DataFrame:
    """The last count written for every window by :func:`to_batches` in update mode."""
    last = Window.partitionBy("window_start").orderBy(F.col("batch_id").desc())
    return (
        spark.read.parquet(folder)
        .withColumn("__place", F.row_number().over(last))
        .where("__place = 1")
        .drop("__place", "batch_id")
    )


def run_until_drained(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is available now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
