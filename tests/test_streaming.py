import datetime

import pytest

from creditloom.schemas import SUBMISSION_STREAM
from creditloom.streaming import submissions


@pytest.fixture
def inbox(spark, tmp_path):
    folder = f"{tmp_path}/in"
    day = datetime.datetime(2024, 1, 1)
    for seconds in ((0, 1, 4), (5, 12), ()):
        rows = [(f"k{s}", day + datetime.timedelta(seconds=s)) for s in seconds]
        frame = spark.createDataFrame(rows, "key string, ts timestamp").coalesce(1)
        frame.write.mode("append").parquet(folder)
    return folder


def source(spark, inbox):
    schema = spark.read.parquet(inbox).schema
    return submissions.from_files(spark, inbox, schema, files_per_batch=1)


def test_counts_per_batch_add_up_and_empty_batches_write_nothing(spark, inbox, tmp_path):
    writer = submissions.batch_counts(source(spark, inbox), f"{tmp_path}/out", f"{tmp_path}/state")
    submissions.run_until_drained(writer)
    counts = sorted(r.records for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert counts == [2, 3]
    # Restarted from its checkpoint, the query has nothing left to do.
    writer = submissions.batch_counts(source(spark, inbox), f"{tmp_path}/out", f"{tmp_path}/state")
    submissions.run_until_drained(writer)
    assert sum(r.records for r in spark.read.parquet(f"{tmp_path}/out").collect()) == 5


def test_tumbling_windows_across_batches(spark, inbox, tmp_path):
    counts = submissions.tumbling_counts(source(spark, inbox), "ts", lateness="1 hour")
    submissions.run_until_drained(
        submissions.to_batches(counts, f"{tmp_path}/out", f"{tmp_path}/state", mode="update")
    )
    latest = submissions.latest_per_window(spark, f"{tmp_path}/out").collect()
    assert sorted((r.window_start.second, r.records) for r in latest) == [(0, 3), (5, 1), (10, 1)]


def test_running_total(spark, inbox, tmp_path):
    total = submissions.running_total(source(spark, inbox))
    submissions.run_until_drained(
        submissions.to_batches(total, f"{tmp_path}/out", f"{tmp_path}/state", mode="complete")
    )
    assert max(r.records for r in spark.read.parquet(f"{tmp_path}/out").collect()) == 5


def test_messages_have_a_fixed_key_and_text_values(spark):
    frame = spark.createDataFrame([(5,), (None,)], "records long")
    messages = submissions.as_messages(frame, "submitted", "records")
    assert messages.schema.simpleString() == SUBMISSION_STREAM.simpleString()
    assert sorted(map(tuple, messages.collect()), key=str) == [("submitted", "5"), ("submitted", None)]


def test_the_counter_sends_one_message_for_each_batch_with_records(spark, inbox, tmp_path):
    writer = submissions.submission_counter(
        source(spark, inbox),
        "submitted",
        submissions.message_files(f"{tmp_path}/out"),
        f"{tmp_path}/state",
    )
    submissions.run_until_drained(writer)
    rows = spark.read.parquet(f"{tmp_path}/out").select("key", "value").collect()
    assert sorted(map(tuple, rows)) == [("submitted", "2"), ("submitted", "3")]


def counted_once(spark, folder, tmp_path, write=None):
    """The counter of distinct events from its checkpoint, until nothing is left."""
    events = submissions.from_files(
        spark, folder, spark.read.parquet(folder).schema, files_per_batch=1
    )
    distinct = submissions.distinct_events(events, "key", "ts", lateness="1 hour")
    writer = submissions.submission_counter(
        distinct, "submitted", write or submissions.message_files(f"{tmp_path}/out"), f"{tmp_path}/state"
    )
    submissions.run_until_drained(writer)


def total(spark, tmp_path):
    return sum(int(r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_a_restart_counts_a_repeated_delivery_once(spark, tmp_path):
    folder, day = f"{tmp_path}/in", datetime.datetime(2024, 1, 1)
    minute = lambda n: day + datetime.timedelta(minutes=n)

    def deliver(*rows):
        frame = spark.createDataFrame(rows, "key string, ts timestamp, x int").coalesce(1)
        frame.write.mode("append").parquet(folder)

    first = [("a", minute(0), 1), ("b", minute(1), 1), (None, minute(1), 1), (None, minute(1), 2)]
    deliver(*first)
    counted_once(spark, folder, tmp_path)
    assert total(spark, tmp_path) == 4
    deliver(*first)  # the same file again, after a restart
    counted_once(spark, folder, tmp_path)
    assert total(spark, tmp_path) == 4
    deliver(("c", minute(30), 1), ("a", minute(30), 9))
    counted_once(spark, folder, tmp_path)
    assert total(spark, tmp_path) == 5


def test_a_batch_that_failed_is_sent_once_after_the_restart(spark, tmp_path):
    folder, day = f"{tmp_path}/in", datetime.datetime(2024, 1, 1)
    send = submissions.message_files(f"{tmp_path}/out")
    for name in "abc":
        rows = [(f"{name}{k}", day, 1) for k in range(3)]
        frame = spark.createDataFrame(rows, "key string, ts timestamp, x int").coalesce(1)
        frame.write.mode("append").parquet(folder)

    def broken(messages, batch_id):
        send(messages, batch_id)
        if batch_id == 1:
            raise OSError("stopped after writing")

    with pytest.raises(Exception, match="stopped after writing"):
        counted_once(spark, folder, tmp_path, broken)
    counted_once(spark, folder, tmp_path)
    assert total(spark, tmp_path) == 9
