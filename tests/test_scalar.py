import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.functions import scalar as s
from creditloom.functions import vocabulary as v


def one(spark, schema, row, **columns):
    return spark.createDataFrame([row], schema).select(
        *(c.alias(n) for n, c in columns.items())
    ).first()


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [(6.0, 3.0, 2.0), (6.0, 0.0, None), (0.0, 0.0, None), (None, 3.0, None), (6.0, None, None)],
)
def test_safe_ratio(spark, a, b, expected):
    assert one(spark, "a double, b double", (a, b), r=s.safe_ratio("a", "b")).r == expected


def test_simple_interest(spark):
    schema = "a double, c double, n double"
    interest = s.simple_interest("a", "c", "n")
    assert one(spark, schema, (12.0, 100.0, 10.0), r=interest).r == pytest.approx(0.02)
    assert one(spark, schema, (12.0, 100.0, 0.0), r=interest).r is None
    assert one(spark, schema, (12.0, 0.0, 10.0), r=interest).r is None


def test_indicators_keep_null(spark):
    row = one(
        spark,
        "x int",
        (None,),
        above=s.indicator(F.col("x") > 0),
        truthy=s.truthy("x"),
        total=s.row_sum(["x", F.lit(1)]),
    )
    assert row.asDict() == {"above": None, "truthy": None, "total": None}
    assert one(spark, "x int", (-3,), t=s.truthy("x")).t == 1
    assert one(spark, "x int", (0,), t=s.truthy("x")).t == 0


def test_lenient_cast_and_sentinel(spark):
    assert one(spark, "x string", ("12a",), r=s.lenient_cast("x", "int")).r is None
    assert one(spark, "x string", ("12",), r=s.lenient_cast("x", "int")).r == 12
    for value, expected in ((365243, None), (-365243, -365243), (None, None), (5, 5)):
        assert one(spark, "x int", (value,), r=s.without_sentinel("x", v.DAYS_SENTINEL)).r == expected


@pytest.mark.parametrize(
    ("text", "missing"),
    [(None, True), ("", True), ("   ", True), ("null", True), (" null ", True), ("x", False)],
)
def test_missing_text(spark, text, missing):
    row = one(spark, "x string", (text,), m=s.text_is_missing("x"), k=s.text_or_null("x"))
    assert row.m is missing
    assert row.k == (None if missing else text)


def test_one_hot_rules_differ_on_null_only(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("zzz",), ("",), (None,)], "c string")
    skip = rows.select(*(x.alias(n) for n, x in s.one_hot("c", "ab", null_as_zero=False).items()))
    zero = rows.select(*(x.alias(n) for n, x in s.one_hot("c", "ab", null_as_zero=True).items()))
    assert skip.columns == zero.columns == ["c_a", "c_b"]
    known = [(1, 0), (0, 1), (0, 0), (0, 0)]
    assert [tuple(r) for r in skip.collect()] == [*known, (None, None)]
    assert [tuple(r) for r in zero.collect()] == [*known, (0, 0)]


def test_names_with_any_characters(spark):
    frame = spark.createDataFrame([("Regional / Local",)], "`CHANNEL: a.b, (c)` string")
    flags = s.one_hot("CHANNEL: a.b, (c)", ["Regional / Local"], null_as_zero=False, prefix="X")
    assert frame.withColumns(flags).first()["X_Regional / Local"] == 1


@pytest.mark.parametrize(
    ("days", "label"),
    [
        (None, None),
        (100, 1),
        (0, 1),
        (-27 * 365 + 1, 1),
        (-27 * 365, 2),
        (-40 * 365, 3),
        (-50 * 365, 4),
        (-65 * 365, 5),
        (-99 * 365 + 1, 5),
        (-99 * 365, 0),
    ],
)
def test_age_band(spark, days, label):
    assert one(spark, "d int", (days,), r=s.age_band("d")).r == label


def test_row_statistics_against_plain_python(spark):
    number = st.one_of(st.none(), st.integers(-50, 50).map(float))
    rows = []

    @settings(max_examples=60, database=None)
    @given(st.tuples(number, number, number))
    def collect(row):
        rows.append(row)

    collect()
    rows.append((None, None, None))
    frame = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, a double, b double, c double"
    )
    abc = ["a", "b", "c"]
    result = frame.select(
        "i",
        s.row_min(abc).alias("min"),
        s.row_max(abc).alias("max"),
        s.row_mean(abc).alias("mean"),
        s.row_median(abc).alias("median"),
        s.row_var_pop(abc).alias("var"),
        s.row_product(abc).alias("product"),
        s.row_weighted_sum(abc, (2.0, 1.0, 3.0)).alias("weighted"),
    ).collect()
    for r in result:
        row = rows[r.i]
        present = [x for x in row if x is not None]
        complete = len(present) == 3
        assert r.min == (min(present) if present else None)
        assert r.max == (max(present) if present else None)
        assert r.median == (statistics.median(present) if present else None)
        assert r["mean"] == (pytest.approx(statistics.fmean(present)) if present else None)
        assert r.var == (
            pytest.approx(statistics.pvariance(present), abs=1e-9) if present else None
        )
        assert r["product"] == (row[0] * row[1] * row[2] if complete else None)
        assert r.weighted == (2 * row[0] + row[1] + 3 * row[2] if complete else None)


def test_vocabulary_sizes():
    assert [len(x) for x in v.PREVIOUS_APPLICATION.values()] == [4, 4, 8, 7, 5, 17, 3, 4]
    assert [len(x) for x in v.BUREAU.values()] == [4, 4, 15]
    assert (len(v.CARD_CONTRACT_STATUS), len(v.POS_CONTRACT_STATUS), len(v.MONTHLY_STATUS)) == (7, 9, 8)
