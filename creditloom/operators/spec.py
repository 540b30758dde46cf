"""Declarative feature specs: segment x aggregate x column, run as one aggregation per grain.

A branch-and-join plan scans and shuffles the same table once per segment and aggregate. A
:class:`FeatureSpec` declares all of them; :func:`build_features` runs every aggregate of constant
size in a single ``groupBy`` whose inputs are masked by the segment predicates, and sends only the
aggregates that cannot join it (distinct counts, medians, top values) through narrow passes of
their own, joined on the key both sides are already partitioned by.

Expressions are assembled as SQL text: a spec has hundreds of them, and one parsed text is far
cheaper to hand to the JVM than a tree of single function calls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.aggregates import REGISTRY, Aggregate, lookup
from creditloom.functions.scalar import named
from creditloom.operators.grouped import HOT_GROUP_ROWS
from creditloom.operators.relational import broadcast_if_small
from creditloom.session import cut_lineage


@dataclass(frozen=True)
class Block:
    """One aggregate over several columns; the unit of output order."""

    fn: str
    columns: tuple[str, ...]


def block(fn: str, *columns: str) -> Block:
    return Block(fn, columns)


@dataclass(frozen=True)
class Segment:
    """A set of rows and the aggregates wanted of it.

    ``rows``   SQL predicate on a row; NULL counts as false.
    ``group``  SQL predicate on aggregates of the whole group: all rows of the groups that meet
               it, none of the others.
    ``reads``  output column name -> input column, where they differ.
    """

    prefix: str
    blocks: tuple[Block, ...]
    rows: str | None = None
    group: str | None = None
    reads: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Feature:
    """One output column of a spec."""

    name: str
    segment: Segment
    fn: str
    column: str

    @property
    def aggregate(self) -> Aggregate:
        return lookup(self.fn)


@dataclass(frozen=True)
class Vocabulary:
    """Categories whose one-hot flags a spec may average without materialising the flags."""

    column: str
    categories: tuple[str, ...]
    null_as_zero: bool

    def flags(self) -> dict[str, str]:
        return {f"{self.column}_{category}": category for category in self.categories}


@dataclass(frozen=True)
class FeatureSpec:
    keys: tuple[str, ...]
    segments: tuple[Segment, ...]
    vocabularies: tuple[Vocabulary, ...] = ()

    def __post_init__(self) -> None:
        # aggregates may be registered after the spec is declared; until then their name stands in
        names = [
            f"{segment.prefix}{column}_{REGISTRY[blk.fn].suffix if blk.fn in REGISTRY else blk.fn}"
            for segment in self.segments
            for blk in segment.blocks
            for column in blk.columns
        ]
        repeated = sorted({n for n in names if names.count(n) > 1} | (set(names) & set(self.keys)))
        if repeated:
            raise ValueError(f"a spec gives these names more than once: {repeated}")

    def features(self) -> list[Feature]:
        return [
            Feature(
                f"{segment.prefix}{column}_{lookup(blk.fn).suffix}",
                segment,
                blk.fn,
                segment.reads.get(column, column),
            )
            for segment in self.segments
            for blk in segment.blocks
            for column in blk.columns
        ]

    def names(self) -> list[str]:
        """Output columns in order: the keys, then every feature as declared."""
        return [*self.keys, *(f.name for f in self.features())]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Compiler:
    """Turns the features of a spec into SQL over rows with one boolean column per predicate."""

    def __init__(self, spec: FeatureSpec) -> None:
        predicates = dict.fromkeys(s.rows for s in spec.segments if s.rows is not None)
        self.flags = {predicate: f"__in{i}" for i, predicate in enumerate(predicates)}
        self.categories = {
            flag: (vocabulary, category)
            for vocabulary in spec.vocabularies
            for flag, category in vocabulary.flags().items()
        }
        self.numbers = {id(segment): i for i, segment in enumerate(spec.segments)}

    def marker(self, segment: Segment) -> str:
        """Column that says whether the group has rows in the segment."""
        return f"__present_{self.numbers[id(segment)]}"

    def flag_columns(self) -> list[str]:
        return [f"coalesce({text}, false) AS {name}" for text, name in self.flags.items()]

    def flag(self, segment: Segment) -> str | None:
        return None if segment.rows is None else self.flags[segment.rows]

    def masked(self, segment: Segment, value: str) -> str:
        flag = self.flag(segment)
        return value if flag is None else f"CASE WHEN {flag} THEN {value} END"

    def present(self, segment: Segment) -> str | None:
        """Whether the group has any row in the segment; None if it always has."""
        conditions = []
        if segment.rows is not None:
            conditions.append(f"max({self.flags[segment.rows]})")
        if segment.group is not None:
            conditions.append(f"({segment.group})")
        return " AND ".join(conditions) or None

    def share(self, segment: Segment, flag: str) -> str:
        """Mean of a one-hot flag, from two counts on the category column itself."""
        vocabulary, category = self.categories[flag]
        column = quoted(vocabulary.column)
        hit = f"CASE WHEN {column} = {_text(category)} THEN 1 END"
        every = "1" if vocabulary.null_as_zero else column
        return (
            f"try_divide(count({self.masked(segment, hit)}), "
            f"count({self.masked(segment, every)}))"
        )

    def fused(self, feature: Feature) -> str:
        segment = feature.segment
        if feature.fn == "mean" and feature.column in self.categories:
            value = self.share(segment, feature.column)
        else:
            value = feature.aggregate.sql.format(self.masked(segment, quoted(feature.column)))
        return self.settled(feature, value, self.present(segment))

    @staticmethod
    def settled(feature: Feature, value: str, present: str | None) -> str:
        """Value of an empty group, and NULL for a group without any row in the segment."""
        empty = feature.aggregate.empty
        if empty is not None:
            value = f"coalesce({value}, {empty}{'D' if isinstance(empty, float) else ''})"
        needs_presence = empty is not None or feature.segment.group is not None
        if present is not None and needs_presence:
            value = f"CASE WHEN {present} THEN {value} END"
        return value


def _distinct_counts(
    base: DataFrame, spec: FeatureSpec, compiler: _Compiler, features: Sequence[Feature]
) -> list[DataFrame]:
    """Aggregates of distinct values in two steps: (key, value) pairs, then pairs per key.

    The pairs are pre-aggregated before both shuffles, so neither a hot key nor a hot value meets
    in one task as raw rows.
    """
    tables = []
    for column in dict.fromkeys(f.column for f in features):
        wanted = [f for f in features if f.column == column]
        flags = [x for x in dict.fromkeys(compiler.flag(f.segment) for f in wanted) if x]
        value = named(column)
        if dict(base.dtypes)[column] == "string":
            value = F.nullif(value, F.lit(""))
        pairs = (
            base.select(*map(quoted, spec.keys), value.alias("__v"), *flags)
            .groupBy(*map(quoted, spec.keys), "__v")
            .agg(F.lit(1).alias("__one"), *[F.max(x).alias(x) for x in flags])
        )
        counts = (
            f"{f.aggregate.sql.format(compiler.masked(f.segment, '__v'))} AS {quoted(f.name)}"
            for f in wanted
        )
        tables.append(pairs.groupBy(*map(quoted, spec.keys)).agg(*map(F.expr, counts)))
    return tables


def _ranked(
    base: DataFrame, spec: FeatureSpec, compiler: _Compiler, feature: Feature
) -> DataFrame:
    flag = compiler.flag(feature.segment)
    rows = base if flag is None else base.where(flag)
    return feature.aggregate.operator(rows, spec.keys, feature.column, feature.name)


def cluster_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    members: DataFrame,
    *,
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Bring the rows of a key together ahead of a wide aggregation.

    The partial result of a wide aggregation is several times the size of a row, and when the few
    rows of a key are scattered, every row becomes such a result on its way to the shuffle.
    Shuffling the rows themselves moves less, and leaves one partial result per key.

    The group sizes are counted on ``members``, a table with the same keys (usually the narrow
    source of ``rows``), in a job of its own. The rows of a key with more than ``hot_rows`` rows
    stay where they are, whether they differ or not: they are many in each task, so the partial
    results are few, and those meet in the final aggregation.
    """
    names = list(map(quoted, keys))
    sizes = members.groupBy(*names).agg(F.count(F.lit(1)).alias("__members"))
    hot = sizes.where(F.col("__members") > hot_rows).na.drop(subset=list(keys))
    if hot.isEmpty():
        return rows.repartition(*names)
    hot = broadcast_if_small(cut_lineage(hot.select(*names)))
    ordinary = rows.join(hot, list(keys), "left_anti").repartition(*names)
    return ordinary.unionByName(rows.join(hot, list(keys), "left_semi"))


def build_features(
    df: DataFrame,
    spec: FeatureSpec,
    *,
    members: DataFrame | None = None,
    hot_rows: int | None = HOT_GROUP_ROWS,
    cluster_from: int | None = 64,
) -> DataFrame:
    """One row per key with all features of the spec, in its column order.

    Rows with a NULL key are left out. A spec of ``cluster_from`` fused features or more shuffles its
    rows by key before it aggregates (see :func:`cluster_by_key`); the result is the same. That
    costs a counting pass over the keys when this is called, and pays where a partial result is
    wider than the few rows it stands for; None never does it. ``members`` is a table with the same
    rows per key as ``df`` that is cheaper to count, if there is one; ``hot_rows=None`` spares the
    counting where no key is hot.
    """
    compiler = _Compiler(spec)
    features = spec.features()
    has_key = " AND ".join(f"{quoted(k)} IS NOT NULL" for k in spec.keys)
    base = df.where(has_key).selectExpr("*", *compiler.flag_columns())

    fused: dict[str, str] = {}
    separate: dict[str, Feature] = {}
    for feature in features:
        if feature.aggregate.execution == "fused":
            fused[feature.name] = compiler.fused(feature)
            continue
        separate[feature.name] = feature
        present = compiler.present(feature.segment)
        if present is not None:
            fused[compiler.marker(feature.segment)] = present
    # A spec of distinct or ranked features only still needs one row per key.
    fused = fused or {"__rows": "count(1)"}
    rows = base
    # Segments chosen by a group predicate reuse the aggregates of the whole table.
    own = sum(f.name in fused and f.segment.group is None for f in features)
    if cluster_from is not None and own >= cluster_from:
        counted = (df if members is None else members).where(has_key)
        rows = cluster_by_key(base, spec.keys, counted, hot_rows=hot_rows)
    result = rows.groupBy(*map(quoted, spec.keys)).agg(
        *(F.expr(f"{text} AS {quoted(name)}") for name, text in fused.items())
    )

    distinct = [f for f in separate.values() if f.aggregate.execution == "distinct"]
    ranked = [f for f in separate.values() if f.aggregate.execution == "ranked"]
    for table in _distinct_counts(base, spec, compiler, distinct):
        result = result.join(table, list(spec.keys), "left")
    for feature in ranked:
        result = result.join(_ranked(base, spec, compiler, feature), list(spec.keys), "left")
    if not separate:
        return result

    def final(name: str) -> str:
        if name not in separate:
            return quoted(name)
        feature = separate[name]
        marker = compiler.marker(feature.segment)
        present = quoted(marker) if marker in fused else None
        return f"{compiler.settled(feature, quoted(name), present)} AS {quoted(name)}"

    return result.selectExpr(*map(final, spec.names()))
