"""Exact top-k by inner product: histograms of scores are refined until each kth value is known.

All candidates are scored against all queries, in blocks. A first pass counts scores per query in
equal bins over the range that scores can have; the bin that holds the kth best score becomes the
range of the next pass, until bins are single scores. A last pass keeps what lies above the kth
score and, of those equal to it, the ones with the smallest ids. Between passes only bin counts
travel, a bounded number for each query and block, summed by Spark; no pass collects scores.

The query set is stated by the caller and meets all rows in blocks. Vectors are stored as rows of
bytes in blocks and scored as matrices inside tasks.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part;
neither do rows without an id; vectors of different lengths do not meet. Rows that repeat an id are
candidates each, but no row is a candidate of a query with its own id; a repeated query row repeats
its result. Ties go to the smaller id. Empty tables give an empty result. Scores beyond 2**61
are clamped to that. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches
from creditloom.session import written

#: Scores are clamped to this size; sums and ranges of them fit a long.
LARGEST = (1 << 61) - 1


def quantised(
    vectors: DataFrame, factor: int = 256, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id`` and ``vector``, the floor of ``factor`` times each component as an integer."""
    values = F.col(vector).cast("array<double>")
    scaled = F.transform(values, lambda x: F.floor(x * F.lit(float(factor))).cast("double"))
    usable = values.isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.where(usable & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("vector")
    )


def blocks_of(vectors: DataFrame, rows: int, salt: int) -> DataFrame:
    """Vectors of equal length in blocks of about ``rows``: ``size``, ``block``, ``ids``, ``values``.

    ``values`` holds the vectors of a block one after the other. Rows are dealt by a hash of id and
    content, over a number of blocks that follows from a count per length, and sorted in a block.
    """
    kinds = (
        vectors.groupBy(F.size("vector").alias("size"))
        .agg(F.greatest(F.ceil(F.count(F.lit(1)) / rows), F.lit(1)).alias("blocks"))
    )
    dealt = (
        vectors.withColumn("size", F.size("vector"))
        .join(kinds, "size")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), "blocks"))
    )
    grouped = dealt.groupBy("size", "block", "blocks").agg(
        F.sort_array(F.collect_list(F.struct("vec_id", "vector"))).alias("rows")
    )
    return grouped.select(
        "size",
        "block",
        "blocks",
        F.transform("rows", lambda r: r["vec_id"]).alias("ids"),
        F.flatten(F.transform("rows", lambda r: r["vector"])).alias("values"),
    )


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products, in the cheapest arithmetic that holds them."""
    bound = _norm(queries) * _norm(candidates)
    if bound < 1 << 24:
        return (queries.astype(np.float32) @ candidates.T.astype(np.float32)).astype(np.int64)
    if bound < 1 << 53:
        return (queries @ candidates.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    product = exact(queries) @ exact(candidates).T
    return np.clip(product, -LARGEST, LARGEST).astype(np.int64)


def _norm(values: np.ndarray) -> float:
    return float(np.sqrt((values * values).sum(axis=1)).max(initial=0.0)) + 1.0


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    bins: int = 512,
    query_rows: int = 1024,
    candidate_rows: int = 8192,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for quantised ``queries`` and ``candidates``."""
    left = written(blocks_of(queries, query_rows, 1))
    right = written(blocks_of(candidates, candidate_rows, 2))
    pairs = _pairs(left, right)
    bound = _score_bound(queries, candidates)
    ranges = None
    span = 2 * bound + 1
    while True:
        width = -(-span // bins)
        counts = _histogram(pairs, ranges, -bound, span, width)
        ranges = written(_narrowed(counts, ranges, k, -bound, width))
        if width == 1:
            break
        span = width
    return _selected(pairs, ranges, k)


def _score_bound(queries: DataFrame, candidates: DataFrame) -> int:
    """No score is larger in size than this."""

    def longest(vectors: DataFrame) -> float:
        squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
        return vectors.agg(F.sqrt(F.max(squares))).first()[0] or 0.0

    product = (longest(queries) + 1) * (longest(candidates) + 1)
    return min(int(min(product, 1e19)) + 1, LARGEST)


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each block of queries with each block of candidates of the same length.

    Blocks of queries are copied for every block of candidates; candidates move once.
    """
    copies = right.select("size", F.col("block").alias("other"))
    asked = left.join(copies, "size").select(
        "size",
        F.col("block").alias("query_block"),
        F.col("other").alias("block"),
        F.col("ids").alias("query_ids"),
        F.col("values").alias("query_values"),
    )
    return asked.join(right.select("size", "block", "ids", "values"), ["size", "block"])


def _with_ranges(pairs: DataFrame, ranges: DataFrame | None) -> DataFrame:
    """Pairs of blocks with the ranges of the queries in them, by slot (place in the block)."""
    if ranges is None:
        nothing = "array(named_struct('slot', 0, 'low', 0L, 'above', 0L))"
        return pairs.withColumn("ranges", F.expr(nothing))
    listed = ranges.groupBy("size", "query_block").agg(
        F.collect_list(F.struct("slot", "low", "above")).alias("ranges")
    )
    return pairs.join(listed, ["size", "query_block"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Size, number of the query block, ids of queries and candidates, scores, ranges by slot."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            size = row["size"].as_py()
            q_ids, q, c_ids, c = (
                row[name].values.to_numpy(zero_copy_only=False)
                for name in ("query_ids", "query_values", "ids", "values")
            )
            score = scores(q.reshape(len(q_ids), size), c.reshape(len(c_ids), size))
            ranges = {r["slot"]: (r["low"], r["above"]) for r in row["ranges"].as_py()}
            yield size, row["query_block"].as_py(), q_ids, c_ids, score, ranges


def _histogram(pairs: DataFrame, ranges: DataFrame | None, low: int, span: int, width: int):
    """Counts by size, query block, slot and bin; bins cut the range of the query, ``span`` long."""

    first = ranges is None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for size, block, q_ids, c_ids, score, known in _blocks(batches):
            slots, found, counts = [], [], []
            for slot, q in enumerate(q_ids.tolist()):
                if not first and slot not in known:
                    continue
                start = low if first else known[slot][0]
                offset = score[slot][c_ids != q] - start
                offset = offset[(offset >= 0) & (offset < span)]
                times = np.bincount(offset // width, minlength=1)
                numbers = np.flatnonzero(times)
                slots += [slot] * len(numbers)
                found += numbers.tolist()
                counts += times[numbers].tolist()
            n = len(slots)
            yield {
                "size": [size] * n,
                "query_block": [block] * n,
                "slot": slots,
                "bin": found,
                "n": counts,
            }

    schema = "size int, query_block long, slot int, bin long, n long"
    return (
        map_batches(_with_ranges(pairs, ranges), count, schema)
        .groupBy("size", "query_block", "slot", "bin")
        .agg(F.sum("n").alias("n"))
    )


def _narrowed(counts: DataFrame, ranges: DataFrame | None, k: int, low: int, width: int):
    """Per query the bin that holds the kth best score, and how many scores lie above it.

    A query with fewer than k candidates gets its lowest bin. At most ``bins`` rows make a group.
    """
    query = ["size", "query_block", "slot"]
    if ranges is None:
        start = {"low": F.lit(low).cast("long"), "above": F.lit(0).cast("long")}
        counts = counts.withColumns(start)
    else:
        counts = counts.join(ranges, query)
    down = Window.partitionBy(*query).orderBy(F.desc("bin"))
    passed = counts.withColumn("reached", F.col("above") + F.sum("n").over(down)).withColumn(
        "is_last", F.lead("bin").over(down).isNull()
    )
    holds = (F.col("reached") >= k) & (F.col("reached") - F.col("n") < k)
    short = F.col("is_last") & (F.col("reached") < k)
    return passed.where(holds | short).select(
        *query,
        (F.col("low") + F.col("bin") * width).alias("low"),
        (F.col("reached") - F.col("n")).alias("above"),
    )


def _selected(pairs: DataFrame, ranges: DataFrame, k: int) -> DataFrame:
    """Scores at or above each query's kth score; of equal ones each block sends the first ids."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for size, block, q_ids, c_ids, score, known in _blocks(batches):
            out: dict[str, list] = {name: [] for name in columns}
            for slot, q in enumerate(q_ids.tolist()):
                if slot not in known:
                    continue
                low, above = known[slot]
                other = c_ids != q
                over = np.flatnonzero((score[slot] > low) & other)
                level = np.flatnonzero((score[slot] == low) & other)
                level = level[np.argsort(c_ids[level], kind="stable")][: k - above]
                chosen = np.concatenate([over, level])
                values = (size, block, slot, q)
                for name, value in zip(columns, values):
                    out[name] += [value] * len(chosen)
                out["vec_id"] += c_ids[chosen].tolist()
                out["score"] += score[slot][chosen].tolist()
            yield out

    schema = "size int, query_block long, slot int, query_id long, vec_id long, score long"
    columns = [part.split()[0] for part in schema.split(", ")]
    found = map_batches(_with_ranges(pairs, ranges), choose, schema)
    best = Window.partitionBy("size", "query_block", "slot").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
