"""Near-duplicates by SimHash, compared bit-sliced.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's word shingles.
Fingerprints that lie within a radius of each other agree in some set of bits, by the pigeonhole
principle or, for wide radii, with a probability that the number of bit sets is chosen for. The
values in those bits are the buckets. In a bucket the fingerprints are stored as bit planes, one
machine word holding one bit of 64 fingerprints; the distances of a fingerprint to all others
are counted in parallel by carry-save adders over the planes, and a block of 64 is abandoned once
all its counters exceed the radius.

Only distinct fingerprints are compared. A bucket gives a spanning forest of its links, not all
pairs; large buckets are split into blocks that meet pairwise. Components are joined from there.

:func:`near_duplicates` links fingerprints and misses none within its radius. :func:`one_of_each`
links texts by the Jaccard similarity of their shingle sets: wide fingerprints of the sets (repeats
counted once) propose pairs, links are checked exactly, and a pair at the lowest similarity is proposed
with a probability that the number of bit sets is chosen for.

Defined results: a null, empty or blank text has the fingerprint zero and is linked like any other;
repeated rows and ties in ids share a component; null ids take part, and a component without any id
has a null name. Other columns are ignored here.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.common import map_batches, quoted, record_batch, rest_of, restored, texts_of
from creditloom.llm.components import components
from creditloom.operators.relational import group_table
from creditloom.session import scratch_folder, written

WORD = 64
#: The mixing constants of a well-known 64-bit finaliser.
GAMMA, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


# --- fingerprints ---------------------------------------------------------------------------


def shingles(text: str, words: int) -> list[bytes]:
    """All runs of ``words`` words of a lower-cased text, repeats included, joined by blanks."""
    # of bytes, lower() changes A-Z alone and split() takes blank, tab, \n, \v, \f and \r
    parts = text.encode().lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    sizes = list(map(len, parts))
    ends = np.cumsum([n + 1 for n in sizes]) - 1
    starts = (ends - sizes).tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    return [joined[a:b] for a, b in zip(starts, ends)]


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of all shingles of a text as unsigned numbers."""
    parts, digest = shingles(text, words), xxhash.xxh64_intdigest
    return np.fromiter((digest(p, seed) for p in parts), dtype=np.uint64, count=len(parts))


def widened(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` 64-bit numbers for each hash: the hash itself, then mixes of it."""
    rows = [hashes]
    for lane in range(1, lanes):
        z = hashes + np.uint64(lane * GAMMA & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX_A)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX_B)
        rows.append(z ^ (z >> np.uint64(31)))
    return np.stack(rows, axis=1)


def majority(hashes: np.ndarray, lanes: int) -> bytes:
    """The fingerprint as big-endian bytes, one 64-bit lane after the other."""
    if not len(hashes):
        return bytes(8 * lanes)
    counts = np.zeros(WORD * lanes, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        wide = widened(hashes[at : at + (1 << 14)], lanes).astype(">u8")
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(wide), -1), axis=1)
        counts += _column_sums(bits)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums of 0/1 columns, 255 rows at a time in bytes."""
    n = len(bits)
    total = np.zeros(bits.shape[1], dtype=np.int64)
    for at in range(0, n, 255):
        total += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return total


def set_fingerprint(text: str, words: int, lanes: int, seed: int = 42) -> bytes:
    """The fingerprint of the set of shingles of a text, and a 128-bit digest of that set.

    A shingle counts once, however often it stands in the text, as in the Jaccard similarity. The
    digest keeps texts apart whose bits agree by chance; texts of equal sets have all bytes equal.
    """
    parts, digest = sorted(set(shingles(text, words))), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, seed) for p in parts), dtype=np.uint64, count=len(parts))
    # no shingle holds a line feed
    return majority(hashes, lanes) + hashlib.blake2b(b"\n".join(parts), digest_size=16).digest()


def with_fingerprints(rows: DataFrame, words: int, lanes: int) -> DataFrame:
    """``rows``, which have a string ``text``, with its ``fingerprint`` by :func:`set_fingerprint`."""
    schema = T.StructType([*rows.schema, T.StructField("fingerprint", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [set_fingerprint(v, words, lanes) for v in texts_of(batch.column("text"))]
            same = {name: batch.column(name) for name in batch.schema.names}
            yield record_batch({**same, "fingerprint": prints}, arrow)

    return rows.mapInArrow(run, schema)


def fingerprints(
    docs: DataFrame,
    words: int = 3,
    lanes: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (binary, 8 bytes for each lane) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            prints = [
                majority(shingle_hashes(value, words), lanes)
                for value in texts_of(batch.column("text"))
            ]
            yield {"doc_id": batch.column("doc_id"), "fingerprint": prints}

    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(narrow, run, f"doc_id {kind}, fingerprint binary")


# --- bit-sliced comparison ------------------------------------------------------------------


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 of them in a machine word."""
    n, size = prints.shape
    bits = np.unpackbits(prints, axis=1)
    padded = np.zeros((-(-n // WORD) * WORD, size * 8), dtype=np.uint8)
    padded[:n] = bits
    packed = np.packbits(np.ascontiguousarray(padded.T), axis=1, bitorder="little")
    return packed.view(np.uint64)


def within(query: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """Which of the fingerprints in ``planes`` differ from ``query`` in at most ``radius`` bits.

    The bits of the distances are themselves planes. Three difference planes go through a carry-save
    adder at a time, giving a sum plane and a carry plane, and both are added to the counter.
    Words in which every counter exceeds the radius are left out of the planes still to come.
    """
    depth = max(1, radius.bit_length()) + 1  # the top counter plane stays set after an overflow
    alive = np.arange(planes.shape[1])
    counters = [np.zeros(len(alive), dtype=np.uint64) for _ in range(depth)]
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    bits = np.unpackbits(query)
    order = np.arange(len(bits))
    step = 24
    for at in range(0, len(order), step):
        for first in range(at, min(at + step, len(order)), 3):
            chosen = order[first : min(first + 3, at + step)]
            parts = [planes[b, alive] ^ ones if bits[b] else planes[b, alive] for b in chosen]
            if len(parts) == 3:
                a, b, c = parts
                half = a ^ b
                _add(counters, half ^ c, 0)
                _add(counters, (a & b) | (half & c), 1)
            else:
                for part in parts:
                    _add(counters, part, 0)
        live = exceeds(counters, radius) != ones
        if not live.all():
            alive = alive[live]
            counters = [c[live] for c in counters]
            if not len(alive):
                break
    inside = np.zeros(planes.shape[1], dtype=np.uint64)
    inside[alive] = ~exceeds(counters, radius)
    return np.flatnonzero(np.unpackbits(inside.view(np.uint8), bitorder="little"))


def _add(counters: list[np.ndarray], carry: np.ndarray, at: int) -> None:
    """Add a plane of weight 2**at; what leaves the top plane keeps it set."""
    last = len(counters) - 1
    for k in range(at, last):
        counters[k], carry = counters[k] ^ carry, counters[k] & carry
    counters[last] = counters[last] | carry


def exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """The counters that are larger than ``radius``, as a plane."""
    larger = np.zeros_like(counters[0])
    equal = ~larger
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            larger = larger | (equal & counters[k])
            equal = equal & ~counters[k]
    return larger


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect all fingerprints within the radius, inside ``left`` or across to ``right``.

    Across two blocks, rows of ``right`` count from ``len(left)``. A search grows one tree after the
    other: what a fingerprint reaches is taken out of the planes still to be compared.
    """
    prints = left if right is None else np.concatenate([left, right])
    side = np.zeros(len(prints), dtype=bool)
    side[len(left) :] = True
    waiting, links = np.arange(len(prints)), []
    planes = planes_of(prints)
    while len(waiting):
        queue, waiting = [int(waiting[0])], waiting[1:]
        planes = planes_of(prints[waiting]) if len(waiting) else None
        while queue and len(waiting):
            node = queue.pop()
            near = within(prints[node], planes, radius)
            near = near[near < len(waiting)]
            if right is not None:
                near = near[side[waiting[near]] != side[node]]
            if len(near):
                found = waiting[near]
                links += [(node, int(other)) for other in found]
                queue += found.tolist()
                waiting = np.delete(waiting, near)
                planes = planes_of(prints[waiting]) if len(waiting) else None
    return links


# --- candidate buckets ----------------------------------------------------------------------


def pigeonhole_sets(bits: int, radius: int, blocks: int) -> list[list[int]]:
    """Sets of bits of which two fingerprints within the radius agree in one at least.

    The bits are cut into ``blocks``; ``radius`` differing bits leave ``blocks - radius`` untouched.
    """
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    cut = [list(map(int, part)) for part in np.array_split(np.arange(bits), blocks)]
    return [sum(chosen, []) for chosen in itertools.combinations(cut, blocks - radius)]


def bucketed(prints: DataFrame, sets: Sequence[Sequence[int]]) -> DataFrame:
    """One row per distinct fingerprint and set of bits: ``fingerprint``, ``bucket``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = batch.column("fingerprint").to_pylist()
            if not values:
                continue
            bits = np.unpackbits(
                np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1), axis=1
            )
            keys: list[bytes] = []
            for number, chosen in enumerate(sets):
                packed = np.packbits(bits[:, list(chosen)], axis=1)
                name = number.to_bytes(2, "big")
                keys += [name + row.tobytes() for row in packed]
            yield {"fingerprint": values * len(sets), "bucket": keys}

    return map_batches(prints, run, "fingerprint binary, bucket binary")


def block_places(buckets: DataFrame, blocks: Column) -> DataFrame:
    """Where each fingerprint is compared: ``bucket``, ``i``, ``j`` and the side, ``left`` or not.

    ``buckets`` has ``fingerprint``, ``bucket`` and ``size``; buckets of one are left out. ``blocks``
    is computed from the rows ``n`` and the sizes ``total`` of a bucket: it is dealt by hash into so
    many blocks, and each pair of blocks is a place, also each block with itself.
    """
    sizes = group_table(
        buckets, ["bucket"], {"n": F.count(F.lit(1)), "total": F.sum("size")}
    ).where("n > 1")
    dealt = (
        buckets.join(sizes, "bucket")
        .withColumn("blocks", blocks.cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return dealt.select(
        "fingerprint",
        "bucket",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("is_left"),
    )


def gathered(places: DataFrame, what: str) -> DataFrame:
    """One row per place: arrays ``left`` and ``right`` of a column; ``right`` is null inside a block."""
    return (
        places.groupBy("bucket", "i", "j")
        .agg(
            F.collect_list(F.when(F.col("is_left"), F.col(what))).alias("left"),
            F.collect_list(F.when(~F.col("is_left"), F.col(what))).alias("right"),
        )
        .select("left", F.when(F.col("i") != F.col("j"), F.col("right")).alias("right"))
    )


def bucket_blocks(buckets: DataFrame, block: int) -> DataFrame:
    """Blocks of fingerprints to be compared, of about ``block`` rows: arrays ``left`` and ``right``.

    A bucket of up to ``block`` is one row with ``right`` null; a larger one is dealt by hash into
    blocks, and each pair of blocks is a row.
    """
    places = block_places(buckets.withColumn("size", F.lit(1)), F.ceil(F.col("n") / block))
    return gathered(places, "fingerprint")


#: Rows of fingerprints that meet each other, or those of a second array.
Block = tuple[np.ndarray, "np.ndarray | None"]
Links = list[tuple[int, int]]


def compare_blocks(
    blocks: DataFrame, link: Callable[[list[Block]], Iterable[Links]], cells: int = 1 << 20
) -> DataFrame:
    """Links ``a``, ``b`` (fingerprints) that ``link`` finds in every block or pair of blocks.

    ``link`` gets blocks with no more than ``cells`` pairs together, or a single one.
    """

    def matrix(values: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1)

    def links_of(held: list[tuple[list[bytes], list[bytes]]]) -> dict:
        a, b = [], []
        parts = [(matrix(left), matrix(right) if right else None) for left, right in held]
        for (left, right), links in zip(held, link(parts)):
            everything = left + right
            a += [everything[x] for x, _ in links]
            b += [everything[y] for _, y in links]
        return {"a": a, "b": b}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0
        for left, right in each_block(batches):
            pairs = len(left) * (len(right) or len(left))
            if held and size + pairs > cells:
                yield links_of(held)
                held, size = [], 0
            held.append((left, right))
            size += pairs
        if held:
            yield links_of(held)

    return map_batches(blocks, run, "a binary, b binary")


def each_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Both sides of one block after the other, ``right`` empty if there is one side only."""
    for batch in batches:
        sides = [batch.column(name) for name in ("left", "right")]
        for row in range(batch.num_rows):
            left, right = (side[row].as_py() for side in sides)
            if left and right != []:
                yield left, right or []


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = 2,
    blocks: int = 4,
    block_rows: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id``.

    Fingerprints of 64 bits link at ``radius`` or fewer differing bits; the component is named by
    the smallest id in it. No link is missed: buckets follow from the pigeonhole principle.
    """
    prints = written(fingerprints(docs, words, 1, doc_id, text))
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    buckets = bucketed(classes.select("fingerprint"), pigeonhole_sets(WORD, radius, blocks))
    links = compare_blocks(
        bucket_blocks(buckets, block_rows), lambda parts: [spanning_links(*part, radius) for part in parts]
    )
    roots = components(links).select(F.col("node").alias("fingerprint"), "root")
    named = classes.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = named.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(members, "fingerprint").select(
        "doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id"
    )


# --- pairs of similar documents -------------------------------------------------------------


@dataclass(frozen=True)
class Sketch:
    """What finds texts whose shingle sets have a Jaccard similarity of at least ``similarity``.

    Fingerprints have ``64 * lanes`` bits. Of two texts at that similarity a bit differs with
    probability ``chance``. The radii leave room for 3.6 standard deviations above the mean. Buckets
    are made from so many random bits that an even spread gives ``bucket_rows`` rows each (8 bits at
    least), and from so many sets of bits that a pair one deviation above the mean shares a bucket
    with probability ``recall``. The formula takes bits for independent; tests measure the recall.
    """

    similarity: float = 0.8
    lanes: int = 4
    recall: float = 0.985
    bucket_rows: int = 1024
    seed: int = 42

    @property
    def chance(self) -> float:
        cosine = 2 * self.similarity / (1 + self.similarity)
        return math.acos(min(cosine, 1.0)) / math.pi

    def radius(self, bits: int) -> int:
        return int(bits * self.chance + 3.6 * math.sqrt(bits * self.chance * (1 - self.chance)))

    def sets(self, rows: int) -> list[list[int]]:
        size = max(8, math.ceil(math.log2(max(rows, 1) / self.bucket_rows)))
        bits = WORD * self.lanes
        differing = self.chance + math.sqrt(self.chance * (1 - self.chance) / bits)
        together = (1 - differing) ** size
        number = 1 if together >= 1 else math.ceil(math.log(1 - self.recall) / math.log1p(-together))
        rng = np.random.default_rng(self.seed)
        return [sorted(rng.choice(bits, size, replace=False).tolist()) for _ in range(number)]


def close_pairs(blocks: list[Block], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that differ in at most ``radius`` bits, as rows of all blocks put one after the other.

    Each row meets the bit planes of its block (of the other side, if there are two) at once: a word
    holds one bit of its distances to 64 rows, and words whose counters all exceed the radius are
    abandoned. Each pair is given once.
    """
    parts = [part for block in blocks for part in block if part is not None]
    rows = np.concatenate(parts)
    # every part starts a new word of the planes
    words = [-(-len(part) // WORD) for part in parts]
    first_word = np.cumsum([0, *words])
    first_row = np.cumsum([0, *map(len, parts)])
    owner = np.repeat(np.arange(len(parts)), list(map(len, parts)))
    slot = first_word[owner] * WORD + np.arange(len(rows)) - first_row[owner]
    row_in = np.full(first_word[-1] * WORD, -1)
    row_in[slot] = np.arange(len(rows))
    padded = np.zeros((len(row_in), rows.shape[1]), dtype=np.uint8)
    padded[slot] = rows
    planes = planes_of(padded)
    row, word, part = [], [], 0
    for left, right in blocks:
        other = part if right is None else part + 1
        r, w = np.indices((len(left), words[other]))
        row.append(r.ravel() + first_row[part])
        word.append(w.ravel() + first_word[other])
        part = other + 1
    row, word = np.concatenate(row), np.concatenate(word)

    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    masks = np.where(np.unpackbits(rows, axis=1).astype(bool).T, ones, np.uint64(0))
    masks = np.ascontiguousarray(masks)
    depth = max(1, radius.bit_length()) + 1
    counters = [np.zeros(len(row), dtype=np.uint64) for _ in range(depth)]
    for at in range(0, len(masks), 3):
        apart = [planes[b][word] ^ masks[b][row] for b in range(at, min(at + 3, len(masks)))]
        if len(apart) == 3:
            a, b, c = apart
            odd = a ^ b
            _add(counters, odd ^ c, 0)
            _add(counters, (a & b) | (odd & c), 1)
        else:
            for plane in apart:
                _add(counters, plane, 0)
        if at % 12 == 9 and at > radius:
            live = exceeds(counters, radius) != ones
            if 2 * live.sum() <= len(live):
                row, word = row[live], word[live]
                counters = [c[live] for c in counters]
                if not len(row):
                    break
    inside = ~exceeds(counters, radius)
    bits = np.unpackbits(inside.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    found, bit = np.nonzero(bits)
    i, j = row[found], row_in[word[found] * WORD + bit]
    return i[i < j], j[i < j]


def distances(wide: np.ndarray, i: np.ndarray, j: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
    """Differing bits of the rows ``i`` and ``j``, some at a time."""
    found = np.empty(len(i), dtype=np.int16)
    for at in range(0, len(i), chunk):
        part = slice(at, at + chunk)
        found[part] = np.bitwise_count(wide[i[part]] ^ wide[j[part]]).sum(axis=1, dtype=np.int16)
    return found


def nearest_links(
    blocks: list[Block], lane_radius: int, radius: int, lanes: int
) -> Iterator[Links]:
    """For each block, links of a shortest spanning forest over the pairs within both radii.

    The first 64 bits are compared bit-sliced; only pairs that pass are compared in full, which is
    in the bytes of ``lanes``. Shortest
    links are the ones most likely to stand an exact check. Across two blocks, rows of the second
    count from the length of the first.
    """
    lane = WORD // 8
    short = [tuple(None if p is None else p[:, :lane] for p in block) for block in blocks]
    i, j = close_pairs(short, lane_radius)
    wide = np.concatenate([p for block in blocks for p in block if p is not None])
    wide = wide[:, : lane * lanes]
    wide = np.ascontiguousarray(wide).view(np.uint64)
    near = distances(wide, i, j) <= radius
    linked = np.unique(np.concatenate([i[near], j[near]]))
    start = 0
    for left, right in blocks:
        end = start + len(left) + (0 if right is None else len(right))
        nodes = linked[np.searchsorted(linked, start) : np.searchsorted(linked, end)]
        side = None if right is None else nodes >= start + len(left)
        tree = _shortest_forest(wide[nodes], side, radius) if len(nodes) else []
        yield [(int(nodes[a]) - start, int(nodes[b]) - start) for a, b in tree]
        start = end


def _shortest_forest(wide: np.ndarray, side: np.ndarray | None, radius: int) -> Links:
    """A shortest spanning forest over fingerprints, across the two sides if there are two."""
    far = np.iinfo(np.int64).max
    best = np.full(len(wide), far)
    source = np.zeros(len(wide), dtype=np.int64)
    waiting = np.ones(len(wide), dtype=bool)
    links = []
    for _ in range(len(wide)):
        at = int(np.argmin(np.where(waiting, best, far)))
        if not waiting[at]:  # all that wait are out of reach: a new tree
            at = int(np.argmax(waiting))
        waiting[at] = False
        if best[at] <= radius:
            links.append((int(source[at]), at))
        distance = np.bitwise_count(wide ^ wide[at]).sum(axis=1, dtype=np.int64)
        if side is not None:
            distance[side == side[at]] = far
        nearer = waiting & (distance < best) & (distance <= radius)
        best[nearer] = distance[nearer]
        source[nearer] = at
    return links


#: Of rows as :func:`open_links` takes them: fingerprint, root, sorted shingle hashes as bytes.
Member = tuple[bytes, bytes, bytes]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``left`` shares with each of ``right``, by lists of holders."""
    counts = np.zeros((len(left), len(right)), dtype=np.int32)
    values, holders = [], []
    for side in (left, right):
        flat = np.concatenate(side)
        owner = np.repeat(np.arange(len(side)), list(map(len, side)))
        order = np.argsort(flat, kind="stable")
        values.append(flat[order])
        holders.append(owner[order])
    common = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
    edges = [
        (np.searchsorted(v, common, "left"), np.searchsorted(v, common, "right")) for v in values
    ]
    for a, b, c, d in zip(*edges[0], *edges[1]):
        counts[np.ix_(holders[0][a:b], holders[1][c:d])] += 1
    return counts


def exact_links(
    left: list[Member],
    right: list[Member],
    measures: tuple[int, int, int],
    similarity: float,
) -> list[tuple[bytes, bytes]]:
    """Links that join the roots of all candidates that are similar enough, by their sets of hashes.

    Candidates lie within both radii and have different roots; an empty ``right`` stands for pairs
    inside ``left``.
    """
    lane_radius, radius, lanes = measures
    other = right or left
    wide = []
    for side in (left, other):
        prints = np.frombuffer(b"".join(r[0] for r in side), np.uint8).reshape(len(side), -1)
        wide.append(np.ascontiguousarray(prints[:, : WORD // 8 * lanes]).view(np.uint64))
    names: dict[bytes, int] = {}
    root = [np.array([names.setdefault(r[1], len(names)) for r in side]) for side in (left, other)]
    near = np.bitwise_count(wide[0][:, None, 0] ^ wide[1][None, :, 0]) <= lane_radius
    i, j = np.nonzero(near & (root[0][:, None] != root[1][None, :]))
    both = np.concatenate(wide)
    live = distances(both, i, j + len(left)) <= radius
    if not right:
        live &= i < j
    i, j = i[live], j[live]
    if not len(i):
        return []
    sets = [[np.frombuffer(r[2], np.uint64) for r in side] for side in (left, other)]
    sizes = [np.array(list(map(len, side))) for side in sets]
    rows, columns = np.unique(i), np.unique(j)
    counts = shared_counts([sets[0][k] for k in rows], [sets[1][k] for k in columns])
    shared = counts[np.searchsorted(rows, i), np.searchsorted(columns, j)]
    union = sizes[0][i] + sizes[1][j] - shared
    passed = shared >= similarity * union
    tree, links = list(range(len(names))), []
    for a, b in zip(i[passed].tolist(), j[passed].tolist()):
        x, y = int(root[0][a]), int(root[1][b])
        while tree[x] != x:
            tree[x] = x = tree[tree[x]]
        while tree[y] != y:
            tree[y] = y = tree[tree[y]]
        if x != y:
            tree[y] = x
            links.append((left[a][0], other[b][0]))
    return links


def with_shingle_hashes(members: DataFrame, words: int) -> DataFrame:
    """``fingerprint``, ``root``, ``label`` and the sorted ``hashes`` of the shingles of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                hashes = [
                    np.unique(shingle_hashes(text, words)).tobytes()
                    for text in texts_of(part.column("text"))
                ]
                same = {name: part.column(name) for name in ("fingerprint", "root", "label")}
                yield {**same, "hashes": hashes}

    return map_batches(
        members.select("fingerprint", "root", "label", "text"),
        run,
        "fingerprint binary, root binary, label binary, hashes binary",
    )


def open_links(
    members: DataFrame,
    sets: Sequence[Sequence[int]],
    measures: tuple[int, int, int],
    similarity: float,
    block_rows: int,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """Links ``a``, ``b`` that join all roots between which a candidate is similar enough.

    ``members`` are those of :func:`with_shingle_hashes`; only rows of one label meet. Blocks are
    bounded in rows and in bytes of hashes.
    """
    narrow = members.select("fingerprint", "label", F.octet_length("hashes").cast("long").alias("size"))
    buckets = (
        bucketed(narrow.select("fingerprint"), sets)
        .join(narrow, "fingerprint")
        .select("fingerprint", F.concat("bucket", "label").alias("bucket"), "size")
    )
    blocks = F.ceil(F.greatest(F.col("n") / block_rows, F.col("total") / block_bytes))
    places = block_places(buckets, blocks).join(
        members.select("fingerprint", F.struct("fingerprint", "root", "hashes").alias("member")),
        "fingerprint",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for left, right in each_block(batches):
            left, right = ([tuple(r.values()) for r in part] for part in (left, right))
            links = exact_links(left, right, measures, similarity)
            yield {"a": [a for a, _ in links], "b": [b for _, b in links]}

    found = map_batches(gathered(places, "member"), run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard(left: str, right: str, words: int) -> float:
    """Similarity of the shingle sets of two texts."""
    a, b = (set(shingles(text, words)) for text in (left, right))
    return len(a & b) / max(len(a | b), 1) if a or b else 1.0


def verified(pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """``a``, ``b``, and ``passed`` if the texts ``text_a``, ``text_b`` are similar enough, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = zip(texts_of(part.column("text_a")), texts_of(part.column("text_b")))
                passed = [jaccard(x, y, words) >= similarity for x, y in texts]
                yield {"a": part.column("a"), "b": part.column("b"), "passed": passed}

    return map_batches(pairs, run, "a binary, b binary, passed boolean")


def similar_groups(
    stored: DataFrame, words: int, sketch: Sketch, block_rows: int
) -> DataFrame:
    """``node``, ``root`` of the rows of ``stored(fingerprint, text)`` that are linked with another.

    First a shortest spanning forest of each bucket is checked on the texts. A link of it that fails
    may part rows that other candidates join. So in the groups around failed links all candidates
    between different components are compared by their sets of shingle hashes, where they meet, and
    links that join the components are checked on the texts. After that no candidate that is similar
    enough lies between two components.
    """
    sets = sketch.sets(stored.count())
    measures = sketch.radius(WORD), sketch.radius(WORD * sketch.lanes), sketch.lanes
    texts = stored.select("fingerprint", "text")

    def checked(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").join(
            texts.select(F.col("fingerprint").alias("a"), F.col("text").alias("text_a")), "a"
        ).join(texts.select(F.col("fingerprint").alias("b"), F.col("text").alias("text_b")), "b")
        return written(verified(both, words, sketch.similarity))

    blocks = bucket_blocks(bucketed(stored.select("fingerprint"), sets), block_rows)
    found = compare_blocks(blocks, lambda parts: nearest_links(parts, *measures))
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = checked(written(pairs))
    candidates = known.count()
    roots = components(known.where("passed"), candidates)
    ends = [
        roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        for end in ("a", "b")
    ]
    apart = written(
        known.where(~F.col("passed"))
        .join(ends[0], "a", "left")
        .join(ends[1], "b", "left")
        .select(*(F.coalesce(f"root_{end}", end).alias(end) for end in ("a", "b")))
        .where("a <> b")
        .distinct(),
        candidates,
    )
    if apart.isEmpty():
        return roots
    # components that failed links would join: every candidate still open lies inside one label
    labels = components(apart, candidates)
    members = (
        stored.select("fingerprint", "text")
        .join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("root", F.coalesce("root", "fingerprint"))
        .join(labels.select(F.col("node").alias("root"), F.col("root").alias("label")), "root")
    )
    hashed = written(with_shingle_hashes(members, words))
    links = written(open_links(hashed, sets, measures, sketch.similarity, min(block_rows, 512)))
    found = links.count()
    if not found:
        return roots
    return components(known.unionByName(checked(links)).where("passed"), candidates + found)


def one_of_each(
    docs: DataFrame,
    words: int = 5,
    sketch: Sketch = Sketch(),
    block_rows: int = 1024,
    buckets: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each group of similar texts stays.

    Texts are linked when their sets of word shingles have a Jaccard similarity of at least
    ``sketch.similarity``; candidates come from SimHash, each link is checked on the texts, and no
    candidate between two of the groups found stays unchecked (:func:`similar_groups`). Of a
    group the row with the smallest id stays (null last; then the smallest content). Texts of equal
    shingle sets are merged within tasks before the shuffle. The rows that are left are stored by fingerprint, so
    that neither the check nor the removal moves all texts again.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.struct(
        F.col(doc_id).isNull().alias("missing"),
        F.col(doc_id).alias("id"),
        F.xxhash64(*quoted(*docs.columns)).alias("content"),
    )
    rows = docs.select(
        F.col(text).cast("string").alias("text"), rest_of(docs, text).alias("row"), order.alias("order")
    )
    marked = with_fingerprints(rows, words, sketch.lanes)
    classes = marked.groupBy("fingerprint").agg(
        F.min_by(F.struct("text", "row", "order"), "order").alias("first")
    )
    name = f"similar_{uuid.uuid4().hex}"
    (
        classes.select("fingerprint", "first.*")
        .write.bucketBy(buckets, "fingerprint")
        .option("path", f"{scratch_folder(spark)}/classes")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    stored = spark.table(name)
    roots = similar_groups(stored, words, sketch, block_rows)
    orders = stored.select("fingerprint", "order").join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint"
    )
    # a group may hold any number of rows: its first is an aggregate, not a sorted window
    first = orders.groupBy("root").agg(F.min(F.struct("order", "fingerprint")).alias("least"))
    losers = roots.select(F.col("node").alias("fingerprint")).join(
        first.select(F.col("least.fingerprint").alias("fingerprint")), "fingerprint", "left_anti"
    )
    kept = stored.join(losers, "fingerprint", "left_anti")
    return restored(kept, docs, "row", **{text: F.col("text")})
