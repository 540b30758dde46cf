"""Removal of lines that many documents share, with two Bloom filters ahead of the exact count.

A line's key is the line stripped of white space at both ends, A-Z in lower case. Every task keeps
two Bloom filters of the keys it meets, one for keys seen once and one for keys seen in a second
document; filters of different tasks merge by bits, and what two tasks saw once is seen twice.
Only lines in the merged second filter, the suspected repeats, are shuffled: they are counted
exactly by key. Rare lines never leave their task.

Filters are cut into segments, so that merging spreads over tasks. Their size follows the number of
lines up to ``max_filter_bytes``; beyond that more lines are suspected and shuffled, and the result
is the same. That bound is also the bound of what is broadcast. Frequent keys are broadcast as
16-byte digests while there are at most ``max_broadcast_keys``; beyond that the lines to drop
reach their document by a join.

Defined results: a null or empty text is one empty line; rows count as documents each, also
repeated ones; an empty line has the empty key, which ``min_key_chars`` leaves alone. With
``keep="first"`` the line of the document with the smallest id stays, once; documents that share that
id, as repeated rows do, keep it each; where all ids are null all those rows keep it. Other columns,
whatever their names, are kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.common import (
    BLANKS,
    map_batches,
    record_batch,
    rest_of,
    restored,
    texts_of,
)
from creditloom.session import written

PROBES = 4


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()  # of bytes, lower() changes A-Z alone


def key_chars(key: bytes) -> int:
    """Code points of a key."""
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


class Shape:
    """Size of a filter in bits, and the places of a hash in it, all in one segment."""

    def __init__(self, lines: int, bits_per_line: int, max_bytes: int, segment_bits: int = 1 << 20):
        wanted = min(max(lines, 1) * bits_per_line, max_bytes * 8)
        self.segment_bits = min(segment_bits, 1 << max(10, math.ceil(math.log2(wanted))))
        self.segments = max(1, math.ceil(wanted / self.segment_bits))

    def segment_of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.segments)) >> np.uint64(32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Bit numbers, one column per probe, within the whole filter."""
        base = self.segment_of(hashes) * np.uint64(self.segment_bits)
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
        step = (mixed >> np.uint64(33)) | np.uint64(1)
        start = hashes & np.uint64(0xFFFFFFFF)
        turns = np.arange(PROBES, dtype=np.uint64)
        inner = (start[:, None] + step[:, None] * turns) % np.uint64(self.segment_bits)
        return base[:, None] + inner

    def empty(self) -> np.ndarray:
        return np.zeros(self.segments * self.segment_bits // 8, dtype=np.uint8)


def contained(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    found = bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(
        np.uint8
    )
    return (found & 1).all(axis=1)


def insert(bits: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(
        bits,
        (flat >> np.uint64(3)).astype(np.int64),
        np.left_shift(np.uint8(1), (flat & np.uint64(7)).astype(np.uint8)),
    )


def see(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray, shape: Shape) -> None:
    """Enter hashes, one for each document that has the key."""
    unique, counts = np.unique(hashes, return_counts=True)
    places = shape.places(unique)
    insert(twice, places[(counts > 1) | contained(once, places)])
    insert(once, places)


def merge(once: np.ndarray, twice: np.ndarray, more_once: np.ndarray, more_twice: np.ndarray):
    twice |= more_twice
    twice |= once & more_once
    once |= more_once


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))


def repeat_filter(lines: DataFrame, shape: Shape, min_chars: int) -> np.ndarray:
    """The merged filter of keys seen in a second document; ``lines`` has the texts as ``text``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        once, twice, seen = shape.empty(), shape.empty(), False
        for batch in batches:
            keys: list[bytes] = []
            for text in texts_of(batch.column("text")):
                found = {line_key(line) for line in text.encode().split(b"\n")}
                keys += [k for k in found if key_chars(k) >= min_chars]
            if keys:
                see(once, twice, hashes_of(keys), shape)
                seen = True
        if seen:
            size = shape.segment_bits // 8
            for k in range(shape.segments):
                part = slice(k * size, (k + 1) * size)
                if once[part].any():
                    yield {
                        "segment": [k],
                        "once": [once[part].tobytes()],
                        "twice": [twice[part].tobytes()],
                    }

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                more = [np.frombuffer(x, dtype=np.uint8) for x in (once, twice)]
                if k in held:
                    merge(*held[k], *more)
                else:
                    held[k] = (more[0].copy(), more[1].copy())
        for k, (_, twice) in held.items():
            yield {"segment": [k], "twice": [twice.tobytes()]}

    parts = map_batches(lines, build, "segment int, once binary, twice binary")
    merged = map_batches(
        parts.repartition("segment"), combine, "segment int, twice binary"
    )
    size, bits = shape.segment_bits // 8, shape.empty()
    for row in merged.toLocalIterator():
        bits[row.segment * size : (row.segment + 1) * size] = np.frombuffer(
            row.twice, dtype=np.uint8
        )
    return bits


def _suspects(lines: list[bytes], bits: np.ndarray, shape: Shape, min_chars: int) -> dict:
    """Position of lines whose key may be a repeat, by key."""
    keys = [line_key(line) for line in lines]
    inside = contained(bits, shape.places(hashes_of(keys))).tolist()
    found: dict[bytes, list[int]] = {}
    for at, (key, hit) in enumerate(zip(keys, inside)):
        if hit and key_chars(key) >= min_chars:
            found.setdefault(key, []).append(at)
    return found


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_key_chars: int = 1,
    keep: str = "none",
    doc_id: str = "doc_id",
    text: str = "text",
    bits_per_line: int = 16,
    max_filter_bytes: int = 64 << 20,
    max_broadcast_keys: int = 1_000_000,
) -> DataFrame:
    """The rows of ``docs`` with the lines of frequent keys taken out of their text.

    A key is frequent when at least ``min_docs`` documents have it. ``keep`` says whether its lines go
    everywhere (``"none"``) or stay at their first occurrence (``"first"``). Columns: ``row`` (the
    others of ``docs``), ``id``, ``was_null``, ``n_lines`` (before), ``n_dropped``, ``kept_text``.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(body.alias("text"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    lines = texts.agg(F.sum(breaks + 1)).first()[0]
    shape = Shape(int(lines or 0), bits_per_line, max_filter_bytes)
    bits = spark.sparkContext.broadcast(repeat_filter(texts, shape, min_key_chars))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys, ids, rows = [], [], []
            for value, name, row in zip(*(c.to_pylist() for c in batch.columns)):
                for key in _suspects(value.encode().split(b"\n"), bits.value, shape, min_key_chars):
                    keys.append(key)
                    ids.append(name)
                    rows.append(row)
            yield {"key": keys, "id": ids, "row": rows}

    id_type = docs.schema[doc_id].dataType
    found_schema = T.StructType(
        [
            T.StructField("key", T.BinaryType()),
            T.StructField("id", id_type),
            T.StructField("row", T.BinaryType()),
        ]
    )
    # rows of equal text have equal lines to drop, so a digest of the text stands for the row
    row_digest = F.unhex(F.md5(body.cast("binary")))
    named = docs.select(body.alias("text"), F.col(doc_id).alias("id"), row_digest.alias("row"))
    suspects = map_batches(named, suspected, found_schema)
    frequent = written(
        suspects.groupBy("key")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
        .where(F.col("docs") >= min_docs)
    )

    carried = (
        rest_of(docs, text).alias("row"),
        F.col(doc_id).alias("id"),
        body.alias("text"),
        F.col(text).isNull().alias("was_null"),
    )
    if frequent.count() <= max_broadcast_keys:
        kinds = [T.StructField("key", T.BinaryType()), T.StructField("first", id_type)]
        short = map_batches(frequent.select("key", "first"), _digests, T.StructType(kinds))
        table = {row.key: row.first for row in short.toLocalIterator()}
        known = spark.sparkContext.broadcast(table)
        source = docs.select(*carried)
        lookup = lambda _: known.value
    else:
        todo = (
            suspects.select("key", "row")
            .distinct()
            .join(frequent.select("key", "first"), "key")
            .groupBy("row")
            .agg(F.collect_list(F.struct("key", "first")).alias("drops"))
            .withColumnRenamed("row", "digest")
        )
        source = (
            docs.select(*carried, row_digest.alias("digest"))
            .join(todo, "digest", "left")
            .select("row", "id", "text", "was_null", "drops")
        )
        lookup = lambda drops: {digest(d["key"]): d["first"] for d in drops or ()}

    result = T.StructType(
        [
            source.schema["row"],
            T.StructField("id", id_type),
            T.StructField("was_null", T.BooleanType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(result)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column("drops").to_pylist() if "drops" in batch.schema.names else None
            counts, dropped, kept = [], [], []
            for at, (value, name) in enumerate(
                zip(batch.column("text").to_pylist(), batch.column("id").to_pylist())
            ):
                known_here = lookup(drops[at] if drops else None)
                parts = value.encode().split(b"\n")
                gone: set[int] = set()
                for key, places in _suspects(parts, bits.value, shape, min_key_chars).items():
                    short = digest(key)
                    if short in known_here:
                        first = keep == "first" and known_here[short] == name
                        gone.update(places[1:] if first else places)
                counts.append(len(parts))
                dropped.append(len(gone))
                kept.append(
                    b"\n".join(p for i, p in enumerate(parts) if i not in gone).decode()
                    if gone
                    else value
                )
            same = {name: batch.column(name) for name in ("row", "id", "was_null")}
            yield record_batch(
                {**same, "n_lines": counts, "n_dropped": dropped, "kept_text": kept}, arrow
            )

    return source.mapInArrow(apply, result)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield {
            "key": [digest(k) for k in batch.column("key").to_pylist()],
            "first": batch.column("first"),
        }


def line_report(applied: DataFrame) -> DataFrame:
    """Per row: lines before, lines dropped, and the SHA-256 of the text that is left."""
    return applied.select(
        F.col("id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def deduplicated(applied: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the text that is left; null texts stay null."""
    left = F.when(~F.col("was_null"), F.col("kept_text"))
    return restored(applied, docs, "row", **{text: left})
