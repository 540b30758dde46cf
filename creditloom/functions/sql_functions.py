"""The row functions under names that SQL knows, as SQL functions: no code leaves the JVM.

``register(spark)`` makes them temporary functions of a session::

    SELECT row_median(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3), age_band(DAYS_BIRTH) FROM application

They give what the column builders of the same names in :mod:`creditloom.functions.scalar` give; Spark
puts their bodies in place of the calls, so they are optimised and compiled like any expression. SQL
functions have a fixed number of parameters: the functions across a row take ``scores`` of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from creditloom.functions.scalar import AGE_BANDS


@dataclass(frozen=True)
class SqlFunction:
    """Parameters (name, type), the type of the result, and the expression."""

    parameters: tuple[tuple[str, str], ...]
    returns: str
    body: str

    def statement(self, name: str) -> str:
        parameters = ", ".join(f"{p} {kind}" for p, kind in self.parameters)
        return (
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
            f"RETURNS {self.returns} RETURN {self.body}"
        )


def _across(scores: int, body: Callable[[Sequence[str]], str]) -> SqlFunction:
    names = [f"s{i + 1}" for i in range(scores)]
    return SqlFunction(tuple((n, "DOUBLE") for n in names), "DOUBLE", body(names))


def _count(names: Sequence[str]) -> str:
    return "(" + " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n in names) + ")"


def _mean(names: Sequence[str]) -> str:
    total = " + ".join(f"coalesce({n}, 0D)" for n in names)
    return f"try_divide({total}, CAST({_count(names)} AS DOUBLE))"


def _variance(names: Sequence[str]) -> str:
    squares = " + ".join(f"coalesce(({n} - {_mean(names)}) * ({n} - {_mean(names)}), 0D)" for n in names)
    return f"try_divide({squares}, CAST({_count(names)} AS DOUBLE))"


def _median(names: Sequence[str]) -> str:
    present = f"array_sort(array_compact(array({', '.join(names)})))"
    size = _count(names)
    lower, upper = (f"get({present}, CAST(floor({n} / 2) AS INT))" for n in (f"({size} - 1)", size))
    return f"CASE WHEN {size} % 2 = 1 THEN {upper} ELSE ({lower} + {upper}) / 2 END"


def _weighted(scores: int) -> SqlFunction:
    names = [f"s{i + 1}" for i in range(scores)]
    weights = [f"w{i + 1}" for i in range(scores)]
    total = " + ".join(f"{n} * {w}" for n, w in zip(names, weights))
    return SqlFunction(tuple((n, "DOUBLE") for n in names + weights), "DOUBLE", total)


def _age_band() -> SqlFunction:
    bands = " ".join(f"WHEN -days < {years * 365} THEN {label}" for years, label in AGE_BANDS)
    return SqlFunction(
        (("days", "BIGINT"),), "INT", f"CASE WHEN days IS NULL THEN CAST(NULL AS INT) {bands} ELSE 0 END"
    )


def sql_functions(scores: int = 3) -> dict[str, SqlFunction]:
    """All functions by name."""
    pair = (("numerator", "DOUBLE"), ("divisor", "DOUBLE"))
    missing = "coalesce(trim(value) IN ('', 'null'), true)"
    return {
        "row_min": _across(scores, lambda n: f"least({', '.join(n)})"),
        "row_max": _across(scores, lambda n: f"greatest({', '.join(n)})"),
        "row_mean": _across(scores, _mean),
        "row_median": _across(scores, _median),
        "row_product": _across(scores, " * ".join),
        "row_sum": _across(scores, " + ".join),
        "row_var_pop": _across(scores, _variance),
        "row_weighted_sum": _weighted(scores),
        "safe_ratio": SqlFunction(pair, "DOUBLE", "try_divide(numerator, divisor)"),
        "simple_interest": SqlFunction(
            (("annuity", "DOUBLE"), ("credit", "DOUBLE"), ("payments", "DOUBLE")),
            "DOUBLE",
            "try_divide(annuity, credit) - try_divide(1D, payments)",
        ),
        "without_sentinel": SqlFunction(
            (("value", "DOUBLE"), ("sentinel", "DOUBLE")), "DOUBLE", "nullif(value, sentinel)"
        ),
        "text_is_missing": SqlFunction((("value", "STRING"),), "BOOLEAN", missing),
        "text_or_null": SqlFunction(
            (("value", "STRING"),), "STRING", f"CASE WHEN NOT {missing} THEN value END"
        ),
        "age_band": _age_band(),
    }


def register(spark: SparkSession, scores: int = 3) -> list[str]:
    """Make the functions known to the session's SQL; their names."""
    found = sql_functions(scores)
    for name, function in found.items():
        spark.sql(function.statement(name))
    return sorted(found)
