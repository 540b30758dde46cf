"""Trailing periods kept up by deliveries: states per key and period that merge.

A feature of the last months is an aggregate over the rows of a few months, most of which the run
before has seen already. So a delivery is reduced to states - count, sum, sum of squared differences
from the mean, least, largest, sketch of distinct values - per key and period, once
(:func:`add_delivery`). The features of a trailing period are merged from the states of its periods
(:func:`trailing_features`): a run reads its own delivery and small states, never the rows of earlier
deliveries. Rows that arrive late add to the states of their own period.

States are stored by period, so that a trailing period opens the folders of its periods only. A
manifest names the stored deliveries; it is replaced in one step when a delivery is complete, and a
repeated delivery takes the place of its first. :func:`fold` merges all deliveries into one and
rolls off the periods that no feature reaches any more.

Variances merge by the differences of the periods' means from the common mean, not by sums of squares,
and so lose no digits to large means.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditloom.functions.aggregates import SKETCH_BITS, lookup
from creditloom.operators.spec import Block, quoted
from creditloom.sources.files import Folder

PERIOD = "__period"
MANIFEST = "_deliveries.json"

#: Part of a state -> SQL over the rows of a period, SQL that merges parts.
PARTS = {
    "n": ("count({})", "sum({})"),
    "sum": ("sum({})", "sum({})"),
    "min": ("min({})", "min({})"),
    "max": ("max({})", "max({})"),
    "m2": ("coalesce(var_pop({}) * count({}), 0D)", "sum({})"),
    "sketch": (f"hll_sketch_agg({{}}, {SKETCH_BITS})", "hll_union_agg({})"),
}

#: Aggregate -> its parts, and SQL over the merged parts.
MERGED = {
    "mean": (("n", "sum"), "try_divide({sum}, {n})"),
    "sum": (("sum",), "{sum}"),
    "min": (("min",), "{min}"),
    "max": (("max",), "{max}"),
    "max_or_zero": (("max",), "coalesce(CAST({max} AS DOUBLE), 0D)"),
    "size": (("n",), "{n}"),
    "var": (("n", "sum", "m2"), "CASE WHEN {n} > 1 THEN {m2} / ({n} - 1) END"),
    "std": (("n", "sum", "m2"), "CASE WHEN {n} > 1 THEN sqrt({m2} / ({n} - 1)) END"),
    "nunique_sketch": (("sketch",), "hll_sketch_estimate({sketch})"),
}


@dataclass(frozen=True)
class PeriodSpec:
    """Aggregates of columns over trailing periods.

    ``period`` is a column with the number of a row's period, counted from a fixed one and growing.
    ``lengths`` says for each output prefix how many periods count, the current one included.
    """

    keys: tuple[str, ...]
    period: str
    blocks: tuple[Block, ...]
    lengths: Mapping[str, int]

    def __post_init__(self) -> None:
        unknown = sorted({b.fn for b in self.blocks} - set(MERGED))
        if unknown:
            raise ValueError(f"these aggregates have no mergeable state: {unknown}")
        names = self.names()
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"a spec gives these names more than once: {repeated}")

    def names(self) -> list[str]:
        """Output columns in order: the keys, then for each prefix every aggregate as declared."""
        return [
            *self.keys,
            *(
                f"{prefix}{column}_{lookup(block.fn).suffix}"
                for prefix in self.lengths
                for block in self.blocks
                for column in block.columns
            ),
        ]

    def parts(self) -> list[tuple[str, str]]:
        """Stored parts: column and name."""
        return list(
            dict.fromkeys(
                (column, part)
                for block in self.blocks
                for column in block.columns
                for part in MERGED[block.fn][0]
            )
        )


def part_name(column: str, part: str) -> str:
    return f"{column}#{part}"


def states(rows: DataFrame, spec: PeriodSpec) -> DataFrame:
    """One row of states per key and period; rows without key or period do not count."""
    whole = " AND ".join(f"{quoted(c)} IS NOT NULL" for c in (*spec.keys, spec.period))
    return (
        rows.where(whole)
        .withColumn(PERIOD, F.col(quoted(spec.period)).cast("int"))
        .groupBy(*map(quoted, spec.keys), PERIOD)
        .agg(
            *(
                F.expr(PARTS[part][0].format(*[quoted(column)] * 2)).alias(part_name(column, part))
                for column, part in spec.parts()
            )
        )
    )


# --- storage --------------------------------------------------------------------------------


def _manifest(spark: SparkSession, root: str) -> dict:
    folder = Folder(spark, root)
    if MANIFEST not in folder.names():
        return {"stored": {}, "folded": [], "columns": None}
    return json.loads(folder.read(MANIFEST))


def _write(stored: DataFrame, root: str) -> str:
    name = f"states-{uuid.uuid4().hex}"
    stored.hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(f"{root}/{name}")
    return name


def add_delivery(rows: DataFrame, root: str, spec: PeriodSpec, delivery: str) -> None:
    """Store the states of a delivery; a repeated delivery replaces itself."""
    spark, root = rows.sparkSession, root.rstrip("/")
    found = _manifest(spark, root)
    if delivery in found["folded"]:
        raise ValueError(f"delivery {delivery} is folded already and cannot be replaced")
    before, reduced = found["stored"].get(delivery), states(rows, spec)
    found["stored"][delivery] = _write(reduced, root)
    found["columns"] = reduced.schema.json()
    folder = Folder(spark, root)
    folder.replace(MANIFEST, json.dumps(found))
    if before is not None:
        folder.delete(before)


def stored_states(spark: SparkSession, root: str, spec: PeriodSpec) -> DataFrame | None:
    """The states of all stored deliveries; None if there are none.

    Column types are those of the last delivery.
    """
    root, found = root.rstrip("/"), _manifest(spark, root)
    if not found["stored"]:
        return None
    reader = spark.read.schema(StructType.fromJson(json.loads(found["columns"])))
    parts = [reader.parquet(f"{root}/{name}") for name in found["stored"].values()]
    return reduce(DataFrame.unionByName, parts)


def fold(spark: SparkSession, root: str, spec: PeriodSpec, *, roll_off: int | None = None) -> None:
    """Merge the stored deliveries into one; periods before ``roll_off`` are left out."""
    root = root.rstrip("/")
    found = _manifest(spark, root)
    whole = stored_states(spark, root, spec)
    if whole is None:
        return
    if roll_off is not None:
        whole = whole.where(F.col(PERIOD) >= roll_off)
    keys = [*map(quoted, spec.keys), PERIOD]
    merged = _with_common_mean(whole, spec, {"": None}, keys).groupBy(*keys).agg(
        *(
            F.expr(_merged_part(column, part, "")).alias(part_name(column, part))
            for column, part in spec.parts()
        )
    )
    # the last name stands for all: what is delivered next comes after it
    name = _write(merged, root)
    folder, before = Folder(spark, root), list(found["stored"].values())
    folded = sorted({*found["folded"], *found["stored"]})
    after = {**found, "stored": {folded[-1]: name}, "folded": folded}
    folder.replace(MANIFEST, json.dumps(after))
    for old in before:
        folder.delete(old)


# --- merging --------------------------------------------------------------------------------


def _mean(column: str, prefix: str) -> str:
    return quoted(f"{prefix}{column}#common mean")


def _with_common_mean(
    whole: DataFrame, spec: PeriodSpec, lengths: Mapping[str, str | None], keys: list[str]
) -> DataFrame:
    """For variances: the mean over all states of a group that lie in a length (SQL condition)."""
    columns = [column for column, part in spec.parts() if part == "m2"]
    if not columns:
        return whole
    over = f"OVER (PARTITION BY {', '.join(keys)})"
    return whole.selectExpr(
        "*",
        *(
            f"try_divide(sum({_masked(column, 'sum', lengths[prefix])}) {over}, "
            f"sum({_masked(column, 'n', lengths[prefix])}) {over}) AS {_mean(column, prefix)}"
            for prefix in lengths
            for column in columns
        ),
    )


def _masked(column: str, part: str, condition: str | None) -> str:
    name = quoted(part_name(column, part))
    return name if condition is None else f"CASE WHEN {condition} THEN {name} END"


def _merged_part(column: str, part: str, prefix: str, condition: str | None = None) -> str:
    """SQL of a part merged over the states of a group."""
    if part != "m2":
        return PARTS[part][1].format(_masked(column, part, condition))
    n, total, m2 = (quoted(part_name(column, p)) for p in ("n", "sum", "m2"))
    moved = f"{m2} + coalesce({n} * pow(try_divide({total}, {n}) - {_mean(column, prefix)}, 2), 0D)"
    return f"sum({moved if condition is None else f'CASE WHEN {condition} THEN {moved} END'})"


def trailing_features(
    spark: SparkSession, root: str, spec: PeriodSpec, current: int
) -> DataFrame:
    """One row per key that has rows in the longest period before and including ``current``.

    As in feature specs, a key without any row in a shorter period has NULL for all its features
    there; a key with rows but no values has 0 where the aggregate says so.
    """
    whole = stored_states(spark, root, spec)
    if whole is None:
        raise ValueError(f"no delivery is stored at {root}")
    longest = max(spec.lengths.values())
    reached = whole.where((F.col(PERIOD) > current - longest) & (F.col(PERIOD) <= current))
    lengths = {
        prefix: None if length == longest else f"{PERIOD} > {current - length}"
        for prefix, length in spec.lengths.items()
    }
    keys = [quoted(k) for k in spec.keys]
    columns = []
    for prefix, condition in lengths.items():
        for block in spec.blocks:
            parts, final = MERGED[block.fn]
            for column in block.columns:
                merged = {part: _merged_part(column, part, prefix, condition) for part in parts}
                value = final.format(**merged)
                aggregate = lookup(block.fn)
                if aggregate.empty is not None and condition is not None:
                    value = f"CASE WHEN max({condition}) THEN {value} END"
                columns.append(f"{value} AS {quoted(f'{prefix}{column}_{aggregate.suffix}')}")
    return (
        _with_common_mean(reached, spec, lengths, keys)
        .groupBy(*keys)
        .agg(*map(F.expr, columns))
        .select(*map(quoted, spec.names()))
    )
