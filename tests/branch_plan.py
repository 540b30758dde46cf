"""The plan a feature spec replaces: one filtered group-by per segment and aggregate, joined.

It exists to check and to measure :func:`creditloom.operators.spec.build_features`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.aggregates import lookup
from creditloom.functions.scalar import named, one_hot
from creditloom.operators.spec import FeatureSpec, Segment, quoted


def _aggregate(fn: str, column: str) -> str:
    if fn == "nunique":
        return f"count(DISTINCT {quoted(column)})"
    return lookup(fn).sql.format(quoted(column))


def _segment(rows: DataFrame, spec: FeatureSpec, segment: Segment) -> DataFrame:
    keys = list(spec.keys)
    if segment.rows is not None:
        rows = rows.where(segment.rows)
    if segment.group is not None:
        members = rows.groupBy(*keys).agg(F.expr(segment.group).alias("__member"))
        rows = rows.join(members.where("__member").select(*keys), keys)
    branches = []
    for blk in segment.blocks:
        aggregates = [
            F.expr(_aggregate(blk.fn, segment.reads.get(c, c))).alias(
                f"{segment.prefix}{c}_{lookup(blk.fn).suffix}"
            )
            for c in blk.columns
        ]
        branches.append(rows.groupBy(*keys).agg(*aggregates))
    return reduce(lambda left, right: left.join(right, keys), branches)


def branch_features(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    for vocabulary in spec.vocabularies:
        missing = {
            name: flag
            for name, flag in one_hot(
                vocabulary.column, vocabulary.categories, null_as_zero=vocabulary.null_as_zero
            ).items()
            if name not in rows.columns
        }
        rows = rows.withColumns(missing)
    rows = rows.na.drop(subset=list(spec.keys))
    first, *others = (_segment(rows, spec, segment) for segment in spec.segments)
    wide = reduce(lambda left, right: left.join(right, list(spec.keys), "left"), others, first)
    return wide.select(*map(named, spec.names()))
