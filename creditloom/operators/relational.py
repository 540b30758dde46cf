"""Joins, semi-joins, unions and two-step groupings that the feature plans are made of.

All of them shuffle on declared keys and leave the join strategy to Catalyst and AQE. A side is
broadcast only after its row count has been checked. Hot keys: aggregates are merged before their
shuffle, and rows meet the aggregates of their group through :func:`group_table`, which lets AQE
split a skewed partition of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import named, within_trailing
from creditloom.session import BROADCAST_BYTES, BROADCAST_ROWS, written


def broadcast_if_small(
    table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark a materialised table for broadcast when it is known to hold few rows and few bytes.

    Bytes are those of the values as text and 16 for each value.
    """
    width = reduce(
        add,
        (F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) for c in table.columns),
        F.lit(16 * len(table.columns)),
    )
    found = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return F.broadcast(table) if found[0] <= rows and found[1] <= size else table


def group_table(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per group, meant to be joined back to the rows of a table that may be skewed.

    AQE splits a hot partition only between two plain shuffles. A table fresh from a ``groupBy`` is
    already partitioned by its keys, so a join on them would take it as it is and the rows of a
    hot key would stay in one task. Grouping by a hash next to the keys does not change the groups
    but makes the join shuffle this side too - few and narrow rows - and with that the rows can be
    split.
    """
    grouped = (
        df.withColumn("__spread", F.xxhash64(*map(named, keys)))
        .groupBy(*map(named, keys), "__spread")
        .agg(
            F.lit(True).alias("__exists"),
            *(column.alias(name) for name, column in (totals or {}).items()),
        )
    )
    return grouped.drop("__spread", "__exists")


def with_group_total(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """Attach aggregates of a row's group to the row; rows with a NULL key get NULLs."""
    return df.join(group_table(df, keys, totals), list(keys), "left")


def with_peer_means(
    df: DataFrame,
    bucket: str,
    columns: Sequence[str],
    prefix: str,
    broadcast_rows: int = BROADCAST_ROWS,
    *,
    stored: bool = False,
) -> DataFrame:
    """Attach to every row the mean of each column over all rows of the same bucket.

    Rows without a bucket get NULLs. There is one peer row per bucket; that small table is
    computed once, its size is checked, and only then is it broadcast, which spares a shuffle of
    the rows on a key with few and uneven values. The rows are read twice, so they are written once
    and what they come from runs once; ``stored`` says that they are read from a table already.
    """
    df = df if stored else written(df)
    peers = (
        df.where(named(bucket).isNotNull())
        .groupBy(named(bucket))
        .agg(*(F.avg(named(c)).alias(prefix + c) for c in columns))
    )
    peers = broadcast_if_small(written(peers), broadcast_rows)
    return df.join(peers, bucket, "left")


def with_key_in(df: DataFrame, chosen: DataFrame, key: str, *, prune: bool = False) -> DataFrame:
    """The rows whose key is among those of ``chosen``.

    The chosen keys are grouped first, so that a key with many rows there costs nothing. ``prune``
    joins them as they are: then Spark can build a Bloom filter of them at run time and put it on the
    scan of ``df``, ahead of its shuffle, where ``chosen`` is a selective filter of a table, small
    enough for that and too large to be broadcast. It is for keys that have few rows each in
    ``chosen``: those of one key meet in one task.
    """
    keys = chosen.select(named(key)) if prune else group_table(chosen, [key])
    return df.join(keys, key, "left_semi")


def latest_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of each group that carry the group's largest ``order`` value, ties included.

    The semi-join runs on (key, order): the rows of a large group spread over its order values
    and only the tied latest rows meet.
    """
    newest = group_table(df, [key], {"__newest": F.max(named(order))}).withColumnRenamed(
        "__newest", order
    )
    return df.join(newest, [key, order], "left_semi")


def with_activity_in(
    df: DataFrame, key: str, offset: str, length: int, *, inclusive: bool = False, prune: bool = False
) -> DataFrame:
    """All rows - old ones too - of the groups that have a row in the trailing period."""
    active = df.where(within_trailing(offset, length, inclusive=inclusive))
    return with_key_in(df, active, key, prune=prune)


def with_single_member_in(
    df: DataFrame, key: str, member: str, offset: str, length: int
) -> DataFrame:
    """All rows of the groups that have exactly one distinct member in the trailing period.

    One distinct member means smallest = largest, so no distinct aggregate is needed.
    """
    recent = df.where(within_trailing(offset, length))
    ends = {"__first": F.min(named(member)), "__last": F.max(named(member))}
    single = (
        group_table(recent, [key], ends)
        .where(F.col("__first") == F.col("__last"))
        .select(named(key))
    )
    return df.join(single, key, "left_semi")


def with_event(
    df: DataFrame, events: DataFrame, key: str, condition: Column, *, prune: bool = False
) -> DataFrame:
    """The rows whose key has at least one event that meets the condition."""
    return with_key_in(df, events.where(condition), key, prune=prune)


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both tables, columns matched by name."""
    return first.unionByName(second)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*map(named, keys)).distinct()


def two_level(
    df: DataFrame,
    inner_keys: Sequence[str],
    inner: Mapping[str, Column],
    outer_keys: Sequence[str],
    outer: Mapping[str, Column],
) -> DataFrame:
    """Aggregate to a fine grain, then aggregate the result to a coarse grain."""
    fine = df.groupBy(*map(named, inner_keys)).agg(*(c.alias(n) for n, c in inner.items()))
    return fine.groupBy(*map(named, outer_keys)).agg(*(c.alias(n) for n, c in outer.items()))


def sum_all_numeric(df: DataFrame, keys: Sequence[str], suffix: str = "") -> DataFrame:
    """Sum of every numeric column that is not a key."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    columns = [
        name
        for name, kind in df.dtypes
        if name not in keys and (kind in numeric or kind.startswith("decimal"))
    ]
    return df.groupBy(*map(named, keys)).agg(
        *(F.sum(named(c)).alias(c + suffix) for c in columns)
    )
