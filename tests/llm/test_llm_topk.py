import math
import random

import pytest
from pyspark.sql import functions as F

from creditloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    return row[0] is not None and row[1] is not None and all(
        x is not None and math.isfinite(x) for x in row[1]
    )


def brute(rows, k, is_query):
    import struct

    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    good = [(r[0], [math.floor(256 * single(x)) for x in r[1]]) for r in rows if usable(r)]
    for q, a in good:
        if not is_query(q):
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q and len(a) == len(b)
        ]
        for rank, (s, c) in enumerate(sorted(scored)[:k], 1):
            yield (q, rank, c, max(-topk.LARGEST, min(topk.LARGEST, -s)))


def run(spark, rows, k=5, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({n: F.lit(1) for n in ("size", "block", "ids", "slot", "rank")})
    vectors = topk.quantised(frame)
    found = topk.top_k(vectors.where("vec_id % 5 = 0"), vectors, k, **more).collect()
    return sorted(map(tuple, found))


def rows_of(n, size=4, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.3) for _ in range(size)], 0) for i in range(n)]


def test_equals_brute_force(spark):
    rows = rows_of(60) + [(100 + i, [0.5, 0.1, 0.0, 0.2], 0) for i in range(30)]
    rows += [(7, [0.1] * 4, 0), (10, [0.3] * 4, 0), (10, [0.3] * 4, 0)]
    rows += [(200, None, 0), (205, [0.1, None, 0.2, 0.3], 0), (210, [float("nan")] * 4, 0)]
    rows += [(215, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [0.1] * 4, 0)]
    rows += [(220, [0.5, 0.5], 0), (221, [0.25, 0.5], 0), (225, [], 0), (226, [], 0)]
    want = sorted(brute(rows, 5, lambda q: q % 5 == 0))
    for more in ({}, {"bins": 3}, {"query_rows": 4, "candidate_rows": 7}):
        assert run(spark, rows, **more) == want


def test_large_components_and_few_candidates(spark):
    rows = [(0, [3e10, -2.0], 0), (1, [-1e10, 5.0], 0), (2, [7e9, 1.0], 0)]
    assert run(spark, rows) == sorted(brute(rows, 5, lambda q: q == 0))
    assert run(spark, rows[:1]) == []


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("k", [1, 40])
def test_other_k(spark, k):
    rows = rows_of(30, seed=k) + rows_of(30, seed=k)
    assert run(spark, rows, k) == sorted(brute(rows, k, lambda q: q % 5 == 0))
