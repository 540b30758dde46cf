import edge
import pytest
from pyspark.sql import functions as F

from creditloom.llm import mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by reshaping the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(full.values())
        out = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: cap * sizes[s] for s in free if out[s] > cap * sizes[s]}
        if not over:
            return full | out
        full |= over


def mixed(frame, **more):
    return mixing.mix(frame, **more).collect()


@pytest.mark.parametrize("rows_per_bucket", [1, 4, 2000])
def test_targets_are_met(spark, rows_per_bucket):
    rows = [
        (i, edge.prose(i, 5 + i % 90), None, [None, "a", "b", "é", "z"][i % 5 if i % 3 else 1])
        for i in range(300)
    ]
    got = mixed(edge.documents(spark, rows), rows_per_bucket=rows_per_bucket)
    sizes, taken = {}, {}
    by_id = {r[0]: r for r in rows}
    for r in got:
        source = by_id[r.doc_id][3]
        assert r.size == len(by_id[r.doc_id][1].split())
        assert 0 <= r.taken <= 3 * r.size
        assert (r.taken > 0) == (r.position is not None)
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
    want = targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        source = by_id[r.doc_id][3]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixed(edge.documents(spark, rows, 7), rows_per_bucket=rows_per_bucket)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_positions_follow_a_rising_schedule(spark):
    rows = [(i, edge.prose(i, 50), None, "ab"[i % 2]) for i in range(400)]
    rising = (((0.0, 0.0), (1.0, 2.0)), mixing.constant(1))
    got = mixing.mix(edge.documents(spark, rows), rising)
    late = {r.doc_id % 2: r.mean for r in got.groupBy((F.col("doc_id") % 2).alias("doc_id")).agg(F.mean("position").alias("mean")).collect()}
    # the mean of a density 2t is 2/3, of an even one 1/2
    assert late[0] == pytest.approx(2 / 3, abs=0.02) and late[1] == pytest.approx(0.5, abs=0.02)


def test_time_inverts_the_integral(spark):
    schedule = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))
    areas = [mixing.integral(schedule) * k / 50 for k in range(51)]
    frame = spark.createDataFrame([(a,) for a in areas], "area double")
    for area, t in frame.select("area", mixing.time_of(schedule, F.col("area"))).collect():
        done = 0.0
        for (a, v), (b, w) in zip(schedule, schedule[1:]):
            x = min(max(t - a, 0.0), b - a)
            done += x * v + (w - v) / (b - a) * x * x / 2
        assert done == pytest.approx(area, abs=1e-9)


def test_training_order(spark):
    frame = edge.with_clashes(edge.documents(spark))
    out = mixing.training_order(frame)
    assert out.schema == frame.schema
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in frame.collect()}
    rows = [(i, edge.prose(i, 40), None, "ab"[i % 2]) for i in range(100)]
    copies = mixing.training_order(edge.documents(spark, rows)).groupBy("source", "doc_id").count()
    words = {r.source: 40 * r.n for r in copies.groupBy("source").agg(F.sum("count").alias("n")).collect()}
    want = targets({"a": 2000, "b": 2000})
    assert all(abs(words[s] - want[s]) <= 20 for s in want)


def test_edges(spark):
    rows = edge.texts()
    got = mixed(edge.with_clashes(edge.documents(spark)))
    assert len(got) == len(rows)
    assert sorted(r.size for r in got)[:4] == [0, 0, 0, 0]
    assert mixed(edge.documents(spark, [])) == []
    alone = mixed(edge.documents(spark, [(1, None, None, None), (2, " ", None, "a")]))
    assert [(r.size, r.target, r.taken) for r in alone] == [(0, 0.0, 0)] * 2


def test_no_python_on_the_way(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (mixing.mix(docs), mixing.training_order(docs)):
        plan = out._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
