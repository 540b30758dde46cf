"""Aggregates by name.

Feature specs name their aggregates as text ("mean", "nunique", "median_lower" ...). The registry
says for each name which suffix the output column gets, the Spark SQL that computes it, and how it
has to be executed at scale:

``fused``     constant-size state, merged before the shuffle: joins the one wide aggregation.
``distinct``  works on the distinct values of a column, found in two narrow grouping steps; its SQL
              sees each value once.
``ranked``    depends on the order of the values in a group: ``operator`` computes it, a function of
              rows, key names, value column and output name that gives one row per group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import ColumnLike, named, safe_ratio


Operator = Callable[[DataFrame, Sequence[str], str, str], DataFrame]
EXECUTIONS = ("fused", "distinct", "ranked")


@dataclass(frozen=True)
class Aggregate:
    suffix: str
    #: SQL with ``{}`` for the aggregated value; empty where only an operator can compute it
    sql: str = ""
    execution: str = "fused"
    #: result for a group that exists but has no usable value (NULL unless stated)
    empty: int | float | None = None
    #: computes a ``ranked`` aggregate
    operator: Operator | None = None

    def __post_init__(self) -> None:
        if self.execution not in EXECUTIONS:
            raise ValueError(f"execution {self.execution!r} is none of {EXECUTIONS}")
        if self.execution == "ranked" and self.operator is None:
            raise ValueError(f"the ranked aggregate {self.suffix} needs an operator")
        if self.execution != "ranked" and not self.sql:
            raise ValueError(f"the aggregate {self.suffix} needs its SQL")


REGISTRY: dict[str, Aggregate] = {}


def register(name: str, aggregate: Aggregate) -> None:
    """Make an aggregate available to feature specs under ``name``."""
    REGISTRY[name] = aggregate


def lookup(name: str) -> Aggregate:
    try:
        return REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown aggregate {name!r}; known: {sorted(REGISTRY)}") from None


#: Sketches of distinct values have 2 ** SKETCH_BITS registers: a standard error of 0.8 %.
SKETCH_BITS = 14

register("mean", Aggregate("MEAN", "avg({})"))
register("min", Aggregate("MIN", "min({})"))
register("max", Aggregate("MAX", "max({})"))
register("sum", Aggregate("SUM", "sum({})"))
register("size", Aggregate("SIZE", "count({})", empty=0))
register("var", Aggregate("VAR", "var_samp({})"))
register("std", Aggregate("STD", "stddev_samp({})"))
register("max_or_zero", Aggregate("MAX", "CAST(max({}) AS DOUBLE)", empty=0.0))
register("nunique", Aggregate("NUNIQUE", "count({})", execution="distinct", empty=0))
# whole numbers and text; the sketches of several runs can be united
register(
    "nunique_sketch",
    Aggregate("NUNIQUE_SKETCH", f"hll_sketch_estimate(hll_sketch_agg({{}}, {SKETCH_BITS}))", empty=0),
)


def ratio_of_sums(numerator: ColumnLike, divisor: ColumnLike) -> Column:
    """sum(numerator) / sum(divisor), NULL when the divisor adds up to zero."""
    return safe_ratio(F.sum(named(numerator)), F.sum(named(divisor)))
