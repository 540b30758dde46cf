"""Document fingerprints by winnowing, and how far they tell an edited text and a neighbour apart.

Every run of ``gram`` code points of a text is hashed; the hashes roll, as differences of running sums
in arithmetic modulo 2^64. Of each window of ``window`` neighbouring hashes the smallest is chosen, of
equal ones the rightmost. The chosen hashes and their positions are the fingerprint. Any passage of
``window + gram - 1`` code points that two texts share puts a hash into both fingerprints, and
passages shorter than ``gram`` never do. A text shorter than a gram is one gram, one with fewer grams
than a window is one window, an empty text has an empty fingerprint. Long texts are worked off in
pieces that overlap by a window.

The likeness of two fingerprints is the Jaccard similarity of their sets of hashes; two empty ones
are equal (1).

For the neighbour, documents are ordered by id (nulls first), those of equal ids by a hash of their
text. The ordered documents are cut into ranges of about equal bytes. Cuts are found on ids
and hashes alone, which Spark sorts; their number is bounded, so they are sent to all tasks. Texts
are shuffled once: to their range, and the first of a range also to the end of the range before it,
as the neighbour of its last. Rows of equal id and text are merged first, with their count, if there
are any; their neighbours are each other. The last document's neighbour is the first.

Defined results: a null text is empty; the neighbour of a single document is itself; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import map_batches
from creditloom.session import written

GRAM, WINDOW = 16, 85

#: An odd multiplier and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Code points worked off at a time.
PIECE = 1 << 20

Fingerprint = tuple[np.ndarray, np.ndarray]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class Winnowing:
    """Fingerprints of texts; every task has one, which keeps the powers of the base."""

    def __init__(self, gram: int = GRAM, window: int = WINDOW) -> None:
        self.gram, self.window = gram, window
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            length = max(size, 1 << 13, min(2 * len(self.up), PIECE + self.gram + self.window))
            steps = np.full(length, BASE, dtype=np.uint64), np.full(length, INVERSE, dtype=np.uint64)
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.multiply.accumulate(step) for step in steps)
        return self.up[:size], self.down[:size]

    def hashes(self, codes: np.ndarray, gram: int) -> np.ndarray:
        """Hashes of all runs of ``gram`` codes."""
        up, down = self.powers(len(codes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * down)])
        grams = len(codes) - gram + 1
        return mixed((sums[gram:] - sums[:grams]) * up[gram - 1 :][:grams])

    def fingerprint(self, text: str) -> Fingerprint:
        """Chosen hashes and their positions, in order of position."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        size = len(codes)
        if not size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if size < self.gram:
            return self.hashes(codes.astype(np.uint64), size), np.zeros(1, np.int64)
        hashes, positions, last = [], [], -1
        overlap = self.gram + self.window - 2
        for start in range(0, max(size - overlap, 1), PIECE):
            found = self.hashes(codes[start : start + PIECE + overlap].astype(np.uint64), self.gram)
            chosen = rightmost_minima(found, min(self.window, len(found)))
            chosen = chosen[chosen + start > last]
            if len(chosen):
                hashes.append(found[chosen])
                positions.append(chosen + start)
                last = int(positions[-1][-1])
        return np.concatenate(hashes), np.concatenate(positions)


def rightmost_minima(values: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the smallest of some window, the rightmost of equals; increasing."""

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] <= values[left], right, left)

    best, width = np.arange(len(values)), 1
    while width * 2 <= window:
        best = better(best[:-width], best[width:])
        width *= 2
    if width < window:
        best = better(best[: width - window], best[window - width :])
    return best[np.flatnonzero(np.diff(best, prepend=-1))]


def likeness(one: Fingerprint, other: Fingerprint) -> float:
    """Jaccard similarity of the hashes."""
    left, right = set(one[0].tolist()), set(other[0].tolist())
    return len(left & right) / len(left | right) if left or right else 1.0


def as_text(fingerprint: Fingerprint) -> str:
    """Hashes as 16 hex digits with their positions: ``hash@position``, separated by blanks."""
    hashes, positions = fingerprint
    return " ".join([f"{h:016x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of another, or all of it."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


def fingerprints(
    docs: DataFrame,
    gram: int = GRAM,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``hashes`` and ``positions`` (arrays) of every text."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        winnowing = Winnowing(gram, window)
        for batch in batches:
            found = [winnowing.fingerprint(t or "") for t in batch.column("text").to_pylist()]
            yield {
                "doc_id": batch.column("doc_id"),
                "hashes": [h.view(np.int64).tolist() for h, _ in found],
                "positions": [p.tolist() for _, p in found],
            }

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(narrow, run, f"doc_id {kind}, hashes array<long>, positions array<long>")


# --- neighbours -----------------------------------------------------------------------------

#: Most cuts that are sent to the tasks (besides one for each partition of the ids).
MAX_CUTS = 10_000

Key = tuple[bool, object, int]


def cuts_of(known: DataFrame, ranges: int) -> list[Key]:
    """Keys of the documents at which a range begins, in order; the first document is among them.

    ``known`` has ``doc_id``, ``hash`` and ``bytes`` of every document.
    """
    total = known.agg(F.sum("bytes")).first()[0] or 0
    step = max(total // max(min(ranges, MAX_CUTS), 1), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        gathered = step  # so that every partition begins with a cut
        for batch in batches:
            sizes = batch.column("bytes").to_numpy()
            at = []
            for i, size in enumerate(sizes.tolist()):
                if gathered >= step:
                    at.append(i)
                    gathered = 0
                gathered += size
            yield {name: batch.column(name).take(pa.array(at, pa.int64())) for name in ("doc_id", "hash")}

    kind = known.schema["doc_id"].dataType.simpleString()
    found = map_batches(known.sort("doc_id", "hash"), run, f"doc_id {kind}, hash long").collect()
    return sorted({key_of(row.doc_id, row.hash) for row in found})


def key_of(doc_id: object, hash_: int) -> Key:
    """A key that sorts as Spark does, nulls first."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, hash_)


def in_ranges(docs: DataFrame, cuts: list[Key]) -> DataFrame:
    """Every row with its ``range``, and the first of a range also (``guest``) in the one before."""
    shared = docs.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cuts = shared.value
        starts = {key: number for number, key in enumerate(cuts)}
        for batch in batches:
            keys = list(
                map(key_of, batch.column("doc_id").to_pylist(), batch.column("hash").to_pylist())
            )
            rows = list(range(len(keys)))
            ranges = [bisect_right(cuts, key) - 1 for key in keys]
            guests = [i for i in rows if keys[i] in starts]
            ranges += [(starts[keys[i]] - 1) % len(cuts) for i in guests]
            flags = [False] * len(rows) + [True] * len(guests)
            taken = batch.take(pa.array(rows + guests, pa.int64())) if guests else batch
            same = {name: taken.column(name) for name in batch.schema.names}
            yield {**same, "range": ranges, "guest": flags}

    schema = ", ".join(f"{name} {kind}" for name, kind in docs.dtypes)
    return map_batches(docs, run, f"{schema}, range int, guest boolean")


REPORT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_report(
    docs: DataFrame,
    gram: int = GRAM,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and two likenesses.

    The edited text ends in the start of the next document; see :func:`edited`.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    known = written(whole.select("doc_id", "hash", F.octet_length("text").cast("long").alias("bytes")))
    counted = known.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n"))
    if counted.where("n > 1").isEmpty():
        rows = whole.withColumn("copies", F.lit(1).cast("long"))
    else:
        rows = whole.groupBy("doc_id", "hash", "text").agg(F.count(F.lit(1)).alias("copies"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = cuts_of(known, 3 * width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        winnowing = Winnowing(gram, window)

        def pairs() -> Iterator[tuple]:
            """Each row with the next one of its range, guests at the end, and their fingerprints."""
            last = None
            for batch in batches:
                columns = ("range", "guest", "doc_id", "text", "copies")
                for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                    if last is not None and last[0][0] != row[0]:
                        last = None
                    if last is not None and last[0][1]:
                        continue
                    this = (row, winnowing.fingerprint(row[3]))
                    if last is not None:
                        yield from reports(last, this)
                    last = this

        def reports(this: tuple, following: tuple) -> Iterator[tuple]:
            (_, _, name, own, copies), found = this
            if copies > 1:
                yield from [report(name, own, found, own, found)] * (copies - 1)
            yield report(name, own, found, following[0][3], following[1])

        def report(name, own, found, next_text, next_found) -> tuple:
            changed = edited(own, next_text)
            again = winnowing.fingerprint(changed)
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            return (
                name,
                len(own),
                digest,
                as_text(found),
                as_text(again),
                likeness(found, again),
                likeness(found, next_found),
            )

        out = []
        for row in pairs():
            out.append(row)
            if len(out) >= 256:
                yield dict(zip(names, zip(*out)))
                out = []
        if out:
            yield dict(zip(names, zip(*out)))

    schema = f"doc_id {kind}, {REPORT}"
    names = T._parse_datatype_string(schema).names
    placed = in_ranges(rows.select("doc_id", "hash", "text", "copies"), cuts)
    ordered = placed.repartition("range").sortWithinPartitions("range", "guest", "doc_id", "hash")
    return map_batches(ordered, run, schema)
