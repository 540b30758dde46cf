"""A content-addressed web archive: payloads stored once, headers apart, records rebuilt by joins.

The archive is two Parquet tables in the shared folder. ``payloads`` holds each distinct payload
once under its SHA-256; ``headers`` holds, for every record, the exact bytes that precede the
payload (WARC header and HTTP header) and the digest of the payload. A record is header, payload
and the closing line breaks; a revisit record has no payload of its own.

Reading checks each payload against its address and fails on a mismatch.

Defined results: a null payload is an empty one; a null id is written as ``none`` and read back as
null; a null url leaves out its field, control characters in a url are percent-encoded. Among equal
payloads the record with the largest id is the response (null ids count as smallest; if all are
null, all are responses). Rows that repeat the id and payload of a response are that response
written again. An empty table gives an empty archive.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.relational import group_table
from creditloom.session import scratch_folder

BREAK = "\r\n"
END = BREAK + BREAK
#: Fixed values of the format.
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RADIX32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    headers: DataFrame
    payloads: DataFrame


def base32_sha1(binary: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32, without padding."""
    digest = F.sha1(binary)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*groups), RADIX32_DIGITS, BASE32_DIGITS)


def record_id(name: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(name.cast("string"), F.lit("none")), F.lit(">"))


def _encoded_url(url: Column) -> Column:
    for code in (0x0D, 0x0A, 0x00):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def write_archive(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    buckets: int | None = None,
) -> Archive:
    """Write one record per row and return the two tables of the archive.

    Payloads of at least ``min_revisit_bytes`` are written in full by one record only; the others
    revisit it. Payloads are bucketed by their digest, so that rebuilding records moves only
    headers. The payload crosses one shuffle, after a first removal of copies within each task.
    """
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_folder(spark)
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    addressed = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.sha2(content, 256).alias("digest"),
        base32_sha1(content).alias("sha1"),
        F.length(content).cast("long").alias("payload_bytes"),
    )
    first = group_table(
        addressed.where(F.col("payload_bytes") >= min_revisit_bytes),
        ["digest"],
        {"response_id": F.max("page_id")},
    )
    known = addressed.join(first, "digest", "left").withColumn(
        "revisits",
        F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")),
    )
    headers = known.select(
        F.col("digest"),
        (~F.col("revisits")).alias("has_payload"),
        _header(date).cast("binary").alias("header"),
    )
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")

    stored = (
        pages.select(F.sha2(content, 256).alias("digest"), content.alias("payload"))
        .dropDuplicates(["digest"])
    )
    name = f"warc_payloads_{uuid.uuid4().hex}"
    (
        stored.write.bucketBy(buckets, "digest")
        .option("path", f"{folder}/payloads")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return Archive(spark.read.schema(headers.schema).parquet(f"{folder}/headers"), spark.table(name))


def _header(date: str) -> Column:
    """WARC header and HTTP header of a record, as text."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        _field("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(BREAK),
    )
    body = F.when(F.col("revisits"), F.lit(0)).otherwise(F.col("payload_bytes"))
    kind = F.when(F.col("revisits"), F.lit("revisit")).otherwise(F.lit("response"))
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", record_id(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _encoded_url(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(F.col("revisits"), F.lit(REVISIT_PROFILE))),
        _field("WARC-Refers-To", F.when(F.col("revisits"), record_id(F.col("response_id")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", (F.octet_length(http) + body).cast("string")),
        F.lit(BREAK),
        http,
    )


def checked_payloads(archive: Archive) -> DataFrame:
    """Stored payloads; fails where one does not have the digest it is stored under."""
    intact = F.sha2(F.col("payload"), 256) == F.col("digest")
    return archive.payloads.select(
        "digest",
        F.when(intact, F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
        .alias("payload"),
    )


def read_records(archive: Archive) -> DataFrame:
    """The records as bytes (``record``), with the address of their payload (``digest``)."""
    with_payload = archive.headers.where("has_payload").join(checked_payloads(archive), "digest")
    end = F.lit(END).cast("binary")
    return with_payload.select(
        "digest", F.concat("header", "payload", end).alias("record")
    ).unionByName(
        archive.headers.where("NOT has_payload").select(
            "digest", F.concat("header", end).alias("record")
        )
    )


def _value(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def _page(identifier: Column) -> Column:
    return F.regexp_extract(identifier, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def parse_records(records: DataFrame) -> DataFrame:
    """The fields of records, and their payload (null for a revisit).

    ``payload_intact`` says whether the payload in the record has the digest its header names.
    """
    text = F.col("record").cast("string")
    split = records.select(
        "digest",
        F.substring_index(text, END, 1).alias("header"),
        F.substring_index(F.substring_index(text, END, 2), END, -1).alias("http"),
        F.col("record"),
    )
    head = F.octet_length("header") + F.octet_length("http") + 2 * len(END)
    body = F.col("record").substr(head + 1, F.octet_length("record") - head - len(END))
    kind = _value(F.col("header"), "WARC-Type")
    parsed = split.select(
        "digest",
        kind.alias("record_type"),
        _page(_value(F.col("header"), "WARC-Record-ID")).alias("page_id"),
        _page(_value(F.col("header"), "WARC-Refers-To")).alias("refers_to"),
        _value(F.col("header"), "WARC-Target-URI").alias("url"),
        F.regexp_replace(_value(F.col("header"), "WARC-Payload-Digest"), "^sha1:", "").alias(
            "payload_digest"
        ),
        F.regexp_extract(F.col("http"), r"Content-Length: (\d+)", 1).cast("long").alias(
            "payload_bytes"
        ),
        F.when(kind == "response", body).alias("payload"),
    )
    return parsed.withColumn(
        "payload_intact",
        F.when(
            F.col("payload").isNotNull(),
            (base32_sha1(F.col("payload")) == F.col("payload_digest"))
            & (F.octet_length("payload") == F.col("payload_bytes")),
        ),
    )


def read_archive(spark: SparkSession, folder: str) -> Archive:
    """The archive written below ``folder`` (without bucketing)."""
    return Archive(
        spark.read.parquet(f"{folder}/headers"), spark.read.parquet(f"{folder}/payloads")
    )


def page_report(archive: Archive) -> DataFrame:
    """Per record: id, type, whom it revisits, and size and digest of the full payload.

    What a record says of its payload is compared with the payload itself, also for a revisit,
    whose payload is looked up by its address; a difference fails the query.
    """
    records = parse_records(read_records(archive))
    stored = checked_payloads(archive).select(
        "digest",
        base32_sha1(F.col("payload")).alias("stored_sha1"),
        F.octet_length("payload").cast("long").alias("stored_bytes"),
    )
    same = (
        F.coalesce(F.col("payload_intact"), F.lit(True))
        & (F.col("payload_digest") == F.col("stored_sha1"))
        & (F.col("payload_bytes") == F.col("stored_bytes"))
    )
    return records.join(stored, "digest").select(
        "page_id",
        F.when(same, F.col("payload_bytes"))
        .otherwise(F.raise_error(F.lit("a record differs from its payload")))
        .alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
        "url",
    )
