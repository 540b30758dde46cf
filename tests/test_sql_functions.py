"""SQL functions against the column builders of the same names."""

import itertools

import pytest
from pyspark.sql import functions as F

from creditloom.functions import scalar, sql_functions

SCORES = ("a", "b", "c")


@pytest.fixture(scope="module")
def table(spark):
    values = [None, 0.0, 0.5, -2.25, 7.0]
    rows = [
        (*row, i % 4 and -250 * i, [None, "", " ", "null", "x", " null "][i % 6], i % 3 * 365243.0)
        for i, row in enumerate(itertools.product(values, repeat=3))
    ]
    rows.append((1.0, 2.0, 3.0, None, "y", None))
    frame = spark.createDataFrame(rows, "a double, b double, c double, days int, t string, d double")
    frame.createOrReplaceTempView("rows_of_scores")
    sql_functions.register(spark)
    return frame


CASES = {
    "row_min(a, b, c)": lambda: scalar.row_min(SCORES),
    "row_max(a, b, c)": lambda: scalar.row_max(SCORES),
    "row_mean(a, b, c)": lambda: scalar.row_mean(SCORES),
    "row_median(a, b, c)": lambda: scalar.row_median(SCORES),
    "row_product(a, b, c)": lambda: scalar.row_product(SCORES),
    "row_sum(a, b, c)": lambda: scalar.row_sum(SCORES),
    "row_var_pop(a, b, c)": lambda: scalar.row_var_pop(SCORES),
    "row_weighted_sum(a, b, c, 2, 1, 3)": lambda: scalar.row_weighted_sum(SCORES, (2.0, 1.0, 3.0)),
    "safe_ratio(a, b)": lambda: scalar.safe_ratio("a", "b"),
    "simple_interest(a, b, c)": lambda: scalar.simple_interest("a", "b", "c"),
    "without_sentinel(d, 365243)": lambda: scalar.without_sentinel("d", 365243.0),
    "text_is_missing(t)": lambda: scalar.text_is_missing("t"),
    "text_or_null(t)": lambda: scalar.text_or_null("t"),
    "age_band(days)": lambda: scalar.age_band("days"),
}


@pytest.mark.parametrize("call", CASES)
def test_equal_to_the_column_builder(spark, table, call):
    key = ("a", "b", "c", "days", "t", "d")
    got = spark.sql(f"SELECT *, {call} AS got FROM rows_of_scores")
    both = got.withColumn("want", CASES[call]())
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).select(*key, "got", "want").collect() == []
    assert dict(both.dtypes)["got"] == dict(both.dtypes)["want"]


def test_every_function_is_compared():
    assert {call.split("(")[0] for call in CASES} == set(sql_functions.sql_functions())


def test_bodies_take_the_place_of_calls(spark, table):
    frame = spark.sql("SELECT row_median(a, b, c) AS m FROM rows_of_scores WHERE age_band(days) = 2")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "row_median" not in plan and "array_sort" in plan


def test_other_numbers_of_scores(spark):
    sql_functions.register(spark, scores=4)
    try:
        found = spark.sql("SELECT row_median(1, NULL, 4, 2), row_max(1, 2, NULL, 9)").first()
        assert tuple(found) == (2.0, 9.0)
    finally:
        sql_functions.register(spark)
