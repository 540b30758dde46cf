import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from creditloom.llm import warc

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/", "<p>é</p>"),
    (5, "http://b/\r\nX: y", "<p>é</p>"),
    (3, None, "<p>é</p>"),
    (5, "http://b/", "<p>é</p>"),
    (7, "http://c/", None),
    (8, "http://d/ é", ""),
    (None, "http://e/", "<p>é</p>"),
    (None, "http://f/", "alone"),
    (None, None, "alone"),
    (9, "http://g/", "x\r\n\r\ny" * 20_000),
]


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= least:
            first[data] = max(first.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        winner = first.get(data)
        revisit = winner is not None and winner != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield (page, len(data), digest, "revisit" if revisit else "response", winner if revisit else None)


@pytest.mark.parametrize("least", [0, 6])
def test_report(spark, least):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3).withColumns(
        {"digest": F.lit(1), "payload": F.lit(2), "record": F.lit(3)}
    )
    archive = warc.write_archive(pages, min_revisit_bytes=least)
    got = warc.page_report(archive).drop("url").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected(ROWS, least), key=repr)
    assert archive.payloads.count() == len({r[2] or "" for r in ROWS})


def test_records_are_well_formed(spark):
    archive = warc.write_archive(spark.createDataFrame(ROWS, PAGES))
    records = [bytes(r.record) for r in warc.read_records(archive).collect()]
    assert len(records) == len(ROWS)
    for record in records:
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        assert len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        assert (fields[b"WARC-Type"] == b"revisit") == (b"WARC-Refers-To" in fields)
    assert not any(b"\r\nX: y" in r.split(b"\r\n\r\n")[0] for r in records)


def test_damage_is_noticed(spark):
    archive = warc.write_archive(spark.createDataFrame(ROWS, PAGES))
    broken = archive.payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    with pytest.raises(Exception, match="damaged payload"):
        warc.page_report(warc.Archive(archive.headers, broken)).collect()


def test_empty(spark):
    archive = warc.write_archive(spark.createDataFrame([], PAGES))
    assert warc.page_report(archive).count() == 0


def test_rebuilding_moves_no_payload(spark):
    archive = warc.write_archive(spark.createDataFrame(ROWS, PAGES), buckets=4)
    joined = warc.checked_payloads(archive).hint("merge").join(archive.headers, "digest")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
