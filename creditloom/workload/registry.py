"""Registration of queries, access to the test tables, and comparable number formats."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.scalar import ColumnLike, named

#: All day and month offsets count from this date.
REFERENCE_DATE = "2001-12-31"


class Tables:
    """The Parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, function, sql)
        return function

    return add


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: entry.run(Tables(spark, folder))

    return {name: bind(entry) for name, entry in _QUERIES.items()}


def statements() -> dict[str, str]:
    return {name: entry.sql for name, entry in _QUERIES.items() if entry.sql is not None}


# --- expressions in both dialects -----------------------------------------------------------


def days_before(column: ColumnLike) -> Column:
    """Day offset of a date from the reference date."""
    return F.datediff(named(column).cast("date"), F.lit(REFERENCE_DATE).cast("date"))


def months_before(column: ColumnLike) -> Column:
    column = named(column)
    return (F.year(column) - 2001) * 12 + F.month(column) - 12


def days_sql(column: str) -> str:
    return f"CAST(date_diff('day', DATE '{REFERENCE_DATE}', CAST({column} AS DATE)) AS INTEGER)"


def months_sql(column: str) -> str:
    return f"CAST((year({column}) - 2001) * 12 + month({column}) - 12 AS INTEGER)"


def cents(column: ColumnLike) -> Column:
    """A money amount as a whole number of cents, so that sums do not depend on their order."""
    return F.round(named(column) * 100).cast("bigint")


def cents_sql(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def sig(column: ColumnLike) -> Column:
    """A double at single precision: hides the summation order of floating-point aggregates."""
    return named(column).cast("float").cast("double")


def sig_sql(expression: str) -> str:
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"


def with_sig(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({name: sig(name) for name in names})
