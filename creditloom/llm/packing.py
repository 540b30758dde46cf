"""Best-fit packing of token sequences under several capacities at once.

Documents become pieces of at most ``max_tokens`` tokens; only longer ones are cut, and the first
piece takes what does not fill a whole sequence. Sequences have three capacities: tokens, documents
and attention cost (sum of squared lengths). A piece goes, longest first, to an open sequence in
which it fits under all three, chosen by the weighted dot product of its demand with what is left,
or by the smallest weighted norm of what would be left; if it fits nowhere a new one is opened.

What a piece demands depends on its length alone. So the plan is made for the histogram of lengths,
which has at most ``max_tokens`` entries however large the corpus, and treats equal sequences
together: the outcome is that of packing piece by piece, but its size and time depend on the number
of different fillings. Pieces then take the places that the plan has for their length, in the
order of their rank among pieces of that length; ranks come from counts per length and hash bucket,
so a length that a third of all pieces have is spread over tasks.

Defined results: a null text is empty and becomes the end token alone; repeated rows and ids are
packed each; ties in rank are broken by id, piece and content, and pieces equal in all of them are
interchangeable; an empty table gives no rows; texts of any length and any run of equal characters
are encoded whole. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches, texts_of
from creditloom.session import written


# --- tokens ---------------------------------------------------------------------------------

#: Texts of these characters alone are cut alike by both tokenizer libraries: ASCII without control
#: characters other than tab and line breaks, and Latin letters with marks.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]*")

#: The library of the fast path searches runs of white space recursively; long ones go the other way.
BLANK_RUNS, LONGEST_BLANKS = re.compile(r"\s{64,}"), 4096


class Encoder:
    """Ids of the byte-level BPE vocabulary at ``path``.

    Names of special tokens in a text become these tokens, as in a plain call of the tokenizer.
    Where a file of the same vocabulary as ranks is given, texts of plain characters without such
    names are encoded by the library that reads it, which gives the same ids several times faster.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, names)) if names else "(?!)")
        self.fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
            )

    def plain(self, text: str) -> bool:
        """Whether both libraries give the same ids for a text, and both can take it."""
        return (
            PLAIN.fullmatch(text) is not None
            and self.special.search(text) is None
            and all(m.end() - m.start() <= LONGEST_BLANKS for m in BLANK_RUNS.finditer(text))
        )

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and self.plain(text):
            found = self.fast.encode_ordinary(text)
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, dtype="<u4")


def tokenised(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 2,
    max_tokens: int = 1024,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all rows: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    ``tokenizer`` and ``ranks`` are files that every executor has. ``with_ids`` adds the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            if with_ids:
                out["ids"] = []
            for name, value in zip(names, texts_of(batch.column("text"))):
                ids = np.append(encoder.ids(value), np.array([end_id], dtype="<u4"))
                first = len(ids) % max_tokens or max_tokens
                edges = [0, *range(first, len(ids) + 1, max_tokens)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    out["doc_id"].append(name)
                    out["piece"].append(piece)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        out["ids"].append(ids[a:b].tolist())
            yield out

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(narrow, run, schema + (", ids array<long>" if with_ids else ""))


# --- the plan -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Capacities:
    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None

    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], dtype=np.int64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.int64)


def plan(
    lengths: dict[int, int],
    capacities: Capacities,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
) -> list[tuple[tuple[int, ...], int]]:
    """Fillings (lengths in order) with the number of sequences that have them.

    ``lengths`` is the histogram. Demands and what is left are taken relative to the capacities.
    """
    if rule not in ("dot", "norm"):
        raise ValueError("rule is 'dot' or 'norm'")
    limits = capacities.limits()
    scale = np.array(weights) / limits

    def scores(before: np.ndarray, need: np.ndarray) -> np.ndarray:
        if rule == "dot":
            return -(before * scale) @ (need * scale)
        return np.square((before - need) * scale).sum(axis=1)

    # one row for each filling that is open: what is left under each capacity
    left = np.empty((0, 3), dtype=np.int64)
    fillings: list[tuple[int, ...]] = []
    counts = np.empty(0, dtype=np.int64)
    for length in sorted(lengths, reverse=True):
        need, waiting = demand(length), lengths[length]
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities")
        while waiting:
            fits = np.flatnonzero((left >= need).all(axis=1) & (counts > 0))
            if len(fits):
                score = scores(left[fits], need)
                at = int(fits[np.argmin(score)])
                filling, rest, bins = fillings[at], left[at], int(counts[at])
                # the next piece goes into the same bin while it fits and no other bin scores better
                others = (score if bins > 1 else score[fits != at]).min(initial=np.inf)
                times, after = 1, rest - need
                while times < waiting and (after >= need).all() and scores(after[None], need)[0] <= others:
                    times, after = times + 1, after - need
                # the last of equal bins has other rivals, so it is looked at by itself
                moved = min(waiting // times, max(bins - 1, 1))
                counts[at] -= moved
            else:
                times = int((limits // need).min())
                times, moved = (times, waiting // times) if waiting >= times else (waiting, 1)
                filling, rest = (), limits
            waiting -= moved * times
            filling, rest = filling + (length,) * times, rest - need * times
            fillings.append(filling)
            left = np.vstack([left, rest])
            counts = np.append(counts, moved)
        if (counts == 0).sum() > 64:
            used = counts > 0
            fillings = [f for f, u in zip(fillings, used) if u]
            left, counts = left[used], counts[used]
    return [(f, int(n)) for f, n in zip(fillings, counts) if n]


#: For each length, runs of pieces: first rank, first sequence, offset.
Places = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def places_of(fillings: list[tuple[tuple[int, ...], int]]) -> Places:
    """Where the pieces of each length go; sequences are numbered from 0."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for filling, times in fillings:
        offset = 0
        for length in filling:
            runs.setdefault(length, []).append((times, sequence, offset))
            offset += length
        sequence += times
    table = {}
    for length, parts in runs.items():
        times, sequences, offsets = np.array(parts, dtype=np.int64).T
        table[length] = (np.cumsum(times) - times, sequences, offsets)
    return table


def place(places: Places, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of a length with the given ranks."""
    starts, sequences, offsets = places[length]
    at = np.searchsorted(starts, ranks, side="right") - 1
    return sequences[at] + ranks - starts[at], offsets[at]


# --- packing --------------------------------------------------------------------------------


def ranked(pieces: DataFrame, rows_per_bucket: int = 2000) -> DataFrame:
    """``pieces`` with their ``rank`` (from 0) among those of equal length."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("pieces"))
    hashed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.join(F.broadcast(counts), "length").withColumn(
        "bucket", F.pmod(hashed, F.ceil(F.col("pieces") / rows_per_bucket))
    )
    starts = (
        dealt.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"),
        )
        .select("length", "bucket", "before")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        dealt.join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
        .drop("bucket", "before", "pieces")
    )


def pack(
    pieces: DataFrame,
    capacities: Capacities = Capacities(),
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``, ``ids_crc32``) with their places.

    Adds ``sequence_id`` and ``offset``. The lengths have at most ``capacities.tokens`` values, the
    bound of what is counted on the driver and sent to the tasks.
    """
    pieces = written(pieces)
    histogram = pieces.groupBy("length").count()
    lengths = {row["length"]: row["count"] for row in histogram.collect()}
    places = places_of(plan(lengths, capacities, rule, weights))
    shared = pieces.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for part in np.split(order, edges[1:]) if len(order) else ():
                sequence[part], offset[part] = place(
                    shared.value, int(length[part[0]]), rank[part]
                )
            same = {name: batch.column(name) for name in pieces_columns}
            yield {**same, "sequence_id": sequence, "offset": offset}

    pieces_columns = pieces.columns
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    return map_batches(ranked(pieces), run, f"{schema}, sequence_id long, offset long")
