import math
import random
import statistics
from collections import defaultdict

import pytest

from creditloom.operators import grouped as g


def _expected_medians(rows, lower):
    groups = defaultdict(list)
    for *key, value in rows:
        groups[tuple(key)]
        if value is not None:
            groups[tuple(key)].append(value)
    pick = statistics.median_low if lower else statistics.median
    return {key: (pick(values) if values else None) for key, values in groups.items()}


def _skewed_rows():
    rng = random.Random(7)
    rows = [("hot", 1, float(rng.randint(0, 10**6))) for _ in range(3000)]
    # Half the rows on each of two values, many different values between them.
    rows += [("steps", 1, 0.0)] * 700 + [("steps", 1, 1e6)] * 700
    rows += [("steps", 1, rng.random() * 1e6) for _ in range(41)]
    rows += [("constant", 1, 4.0)] * 900
    rows += [(None, 2, float(i % 97)) for i in range(1000)]
    rows += [("small", None, x) for x in (3.0, 1.0, 2.0, 2.0)]
    rows += [("empty", 1, None), ("single", 1, -0.5), ("single", 1, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("lower", [True, False])
@pytest.mark.parametrize("hot_rows", [10**9, 12])
def test_group_median_is_exact_with_and_without_hot_groups(spark, lower, hot_rows):
    rows = _skewed_rows()
    frame = spark.createDataFrame(rows, "a string, b int, v double").repartition(5)
    result = g.group_median(frame, ["a", "b"], "v", "m", lower=lower, hot_rows=hot_rows)
    assert result.columns == ["a", "b", "m"]
    assert {(r.a, r.b): r.m for r in result.collect()} == _expected_medians(rows, lower)


def test_top_k_mean(spark):
    rows = [("a", x) for x in (1.0, 9.0, 9.0, 5.0, None)] + [("b", 2.0), ("c", None), ("d", 1.0), ("d", 4.0)]
    frame = spark.createDataFrame(rows, "k string, v double")
    result = {r.k: r.t for r in g.top_k_mean(frame, ["k"], "v", "t", 3).collect()}
    assert result == {"a": pytest.approx(23 / 3), "b": 2.0, "c": 0.0, "d": 2.5}


def test_top_k_limits_rows_before_the_shuffle(spark, capsys):
    frame = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    g.top_k_mean(frame, ["k"], "v", "t").explain()
    plan = capsys.readouterr().out
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_first_last_is_definite_under_ties(spark):
    rows = [(1, 5, 20.0), (1, 5, 10.0), (1, 9, 7.0), (1, 9, None), (2, None, 3.0), (2, 4, 8.0)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, o int, v double").repartition(3)
        result = g.first_last(frame, "k", ["o"], first=["v"], last=["v"]).collect()
        assert {r.k: (r.v_FIRST, r.v_LAST) for r in result} == {1: (10.0, 7.0), 2: (3.0, 8.0)}


def test_latest_value_may_be_null(spark):
    rows = [(1, 1, 1, 5.0), (1, 2, 1, None), (2, 3, 1, 4.0), (2, 3, 2, 6.0)]
    frame = spark.createDataFrame(rows, "k int, day int, id int, v double")
    result = {r.k: r.x for r in g.latest_value(frame, "k", "v", ["day", "id"], "x").collect()}
    assert result == {1: None, 2: 6.0}


def test_lower_median_of_even_groups_is_the_lower_middle(spark):
    frame = spark.createDataFrame([(1, float(x)) for x in (4, 1, 3, 2)], "k int, v double")
    assert g.group_median(frame, ["k"], "v", "m").first().m == 2.0
    assert g.group_median(frame, ["k"], "v", "m", lower=False).first().m == 2.5
    assert math.isclose(g.group_median(frame, ["k"], "v", "m", hot_rows=1).first().m, 2.0)


@pytest.mark.parametrize("hot_rows", [None, 5_000_000, 10])
def test_median_and_totals_in_one_pass(spark, capsys, hot_rows):
    from pyspark.sql import functions as F

    frame = spark.range(200).selectExpr("IF(id % 3 = 0, 1, id % 40) AS k", "id * 7 % 101 AS v")
    totals = {"mean": F.avg("v"), "rows": F.count("v")}
    out = g.group_median(frame, ["k"], "v", "m", hot_rows=hot_rows, totals=totals)
    if hot_rows != 10:
        out.explain()
        assert capsys.readouterr().out.count("Exchange") == 1
    groups = {}
    for r in frame.collect():
        groups.setdefault(r.k, []).append(r.v)
    for r in out.collect():
        values = sorted(groups.pop(r.k))
        assert (r.m, r.rows) == (values[(len(values) - 1) // 2], len(values))
        assert math.isclose(r["mean"], sum(values) / len(values))
    assert not groups


def test_latest_value_is_hashed_where_the_order_fits(spark, capsys):
    low, high = -(2**63), 2**63 - 1
    rows = [
        (1, -5, 7, 1.0), (1, -5, 9, 2.0), (1, None, high, 3.0), (2, None, None, 4.0), (2, None, low, 5.0),
        (3, 2**31 - 1, low, 6.0), (3, 2**31 - 1, None, 7.0), (4, -(2**31), high, None), (4, None, high, 8.0),
    ]
    frame = spark.createDataFrame(rows, "k int, day int, id long, v double")
    out = g.latest_value(frame, "k", "v", ["day", "id"], "x")
    assert {r.k: r.x for r in out.collect()} == {1: 2.0, 2: 5.0, 3: 6.0, 4: None}
    out.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    text = frame.withColumn("day", frame.day.cast("string"))
    assert {r.k: r.x for r in g.latest_value(text, "k", "v", ["day", "id"], "x").collect()}[1] == 2.0
