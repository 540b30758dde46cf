"""Trailing periods from stored states: equal to a full recomputation, and read one delivery only."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from creditloom.operators import periods
from creditloom.operators.periods import PeriodSpec, add_delivery, fold, trailing_features
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features

SPEC = PeriodSpec(
    keys=("client", "kind"),
    period="month",
    blocks=(
        block("mean", "amount"),
        block("var", "amount"),
        block("std", "amount"),
        block("sum", "amount", "days"),
        block("min", "amount", "days"),
        block("max", "days"),
        block("max_or_zero", "amount"),
        block("size", "days"),
        block("nunique_sketch", "name"),
    ),
    lengths={"L3_": 3, "L9_": 9},
)
SCHEMA = "client long, kind string, month int, amount double, days int, name string"


def made(seed, months, rows=400):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, *range(12)]),
            rng.choice(["a", "b"]),
            rng.choice([None, *months, *months]),
            rng.choice([None, 1e9 + rng.randrange(50), float(rng.randrange(9))]),
            rng.choice([None, rng.randrange(-40, 40)]),
            rng.choice([None, f"n{rng.randrange(30)}"]),
        )
        for _ in range(rows)
    ]


def recomputed(spark, rows, current):
    """The same features by one specification over all rows."""
    frame = spark.createDataFrame(rows, SCHEMA).where(f"month <= {current} AND month > {current - 9}")
    segments = [
        Segment(prefix, SPEC.blocks, rows=f"month > {current - length}")
        for prefix, length in SPEC.lengths.items()
    ]
    return build_features(frame, FeatureSpec(SPEC.keys, tuple(segments)))


def same(got, want):
    names = got.columns
    assert names == want.columns
    got, want = ({(r[0], r[1]): r for r in f.collect()} for f in (got, want))
    assert set(got) == set(want)
    for key in want:
        for name, a, b in zip(names, got[key], want[key]):
            close = isinstance(b, float) and a is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
            assert a == b or close, (key, name, a, b)


def test_three_deliveries_equal_a_recomputation(spark, tmp_path):
    root = str(tmp_path / "states")
    parts = {"1": made(1, range(0, 6)), "2": made(2, range(4, 9)), "3": made(3, [2, 9, 10])}
    for name, rows in parts.items():
        add_delivery(spark.createDataFrame(rows, SCHEMA), root, SPEC, name)
    everything = sum(parts.values(), [])
    for current in (10, 7):
        same(trailing_features(spark, root, SPEC, current), recomputed(spark, everything, current))
    # a delivery is repeated with other rows, then all are folded and old periods go
    parts["2"] = made(20, range(4, 9), 300)
    add_delivery(spark.createDataFrame(parts["2"], SCHEMA), root, SPEC, "2")
    everything = sum(parts.values(), [])
    same(trailing_features(spark, root, SPEC, 10), recomputed(spark, everything, 10))
    fold(spark, root, SPEC, roll_off=2)
    same(trailing_features(spark, root, SPEC, 10), recomputed(spark, everything, 10))
    later = made(4, [10, 11])
    add_delivery(spark.createDataFrame(later, SCHEMA), root, SPEC, "4")
    same(trailing_features(spark, root, SPEC, 11), recomputed(spark, everything + later, 11))
    with pytest.raises(ValueError, match="folded"):
        add_delivery(spark.createDataFrame(later, SCHEMA), root, SPEC, "2")


def test_a_run_reads_one_delivery_and_the_periods_of_its_features(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "states")
    inputs = []
    for name in ("1", "2", "3"):
        folder = str(tmp_path / f"in{name}")
        spark.createDataFrame(made(int(name), range(0, 12)), SCHEMA).write.parquet(folder)
        inputs.append(spark.read.parquet(folder))
    for name, rows in zip("12", inputs):
        add_delivery(rows, root, SPEC, name)
    written, write = [], periods._write
    monkeypatch.setattr(periods, "_write", lambda df, at: written.append(df.inputFiles()) or write(df, at))
    add_delivery(inputs[2], root, SPEC, "3")
    assert {re.search(r"/in(\d)/", f)[1] for f in written[0]} == {"3"}
    found = trailing_features(spark, root, SPEC, 11)
    assert not any("/in" in f for f in found.inputFiles())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__period" in text and "> 2)" in text


def test_states_of_a_hot_key_are_added_up_before_the_shuffle(spark):
    frame = spark.range(0, 100_000, 1, 8).selectExpr(
        "1L AS client", "'a' AS kind", "int(id % 3) AS month", "double(id) AS amount",
        "int(id) AS days", "string(id % 77) AS name",
    )
    found = periods.states(frame, SPEC)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and found.count() == 3


def test_sketches_are_close(spark, tmp_path):
    """Measured error of united sketches against the exact count."""
    spec = PeriodSpec(("key",), "month", (block("nunique_sketch", "value"),), {"": 4})
    root = str(tmp_path / "sketches")
    frame = spark.range(0, 600_000, 1, 8).selectExpr(
        "id % 5 AS key", "int(id % 7) AS month", "xxhash64(id % (20011 * (1 + id % 5))) AS value"
    )
    for month in range(7):
        add_delivery(frame.where(F.col("month") == month), root, spec, str(month))
    found = {r.key: r.value_NUNIQUE_SKETCH for r in trailing_features(spark, root, spec, 6).collect()}
    exact = frame.where("month > 2").groupBy("key").agg(F.countDistinct("value").alias("n")).collect()
    errors = [abs(found[r.key] - r.n) / r.n for r in exact]
    assert len(errors) == 5 and max(errors) < 0.03


def test_names_and_unknown_aggregates(spark, tmp_path):
    with pytest.raises(ValueError, match="mergeable"):
        PeriodSpec(("k",), "m", (block("median", "x"),), {"A_": 1})
    with pytest.raises(ValueError, match="more than once"):
        PeriodSpec(("k",), "m", (block("max", "x"), block("max_or_zero", "x")), {"A_": 1})
    with pytest.raises(ValueError, match="no delivery"):
        trailing_features(spark, str(tmp_path), SPEC, 1)


def test_empty_delivery(spark, tmp_path):
    root = str(tmp_path / "states")
    add_delivery(spark.createDataFrame([], SCHEMA), root, SPEC, "1")
    assert trailing_features(spark, root, SPEC, 1).isEmpty()
