"""Order statistics per group that stay exact when one group holds a large share of all rows.

Spark's exact percentile keeps the values of a group in the memory of one task. That is right for
ordinary groups. Groups above a row limit go through :func:`_select_rank` instead, which narrows
the value interval around the wanted rank with constant-size aggregates and never moves the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.aggregates import Aggregate, register
from creditloom.functions.scalar import named
from creditloom.operators.relational import broadcast_if_small
from creditloom.session import cut_lineage, written

#: Groups with more rows than this are not aggregated in the memory of one task.
HOT_GROUP_ROWS = 5_000_000

#: Grid of the sketch used for narrowing, and its accuracy.
_GRID = 200
_ACCURACY = 10_000


def _join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Join on the group keys, treating NULL keys as equal like ``groupBy`` does."""
    other = {k: f"__group_{k}" for k in keys}
    groups = groups.withColumnsRenamed(other)
    same = reduce(and_, (named(k).eqNullSafe(named(other[k])) for k in keys))
    joined = rows.join(groups, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*other.values())


def _direct(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    lower: bool,
    totals: Mapping[str, Column],
) -> DataFrame:
    quoted = "`" + value.replace("`", "``") + "`"
    text = (
        f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {quoted})" if lower else f"median({quoted})"
    )
    return df.groupBy(*map(named, keys)).agg(
        F.expr(text).cast("double").alias(out), *(c.alias(name) for name, c in totals.items())
    )


def _select_rank(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], out: str, limit: int
) -> DataFrame:
    """Exact value at rank ``__rank`` of ``__v`` for every group of ``groups``.

    ``groups`` holds the keys and the rank; its size has been checked by the caller. Each round
    sketches the candidate interval on a quantile grid, counts exactly how many rows lie below,
    between and above two grid values around the rank, and keeps the part that must hold the rank.
    It ends when no interval holds more than ``limit`` different values.
    """
    value, rank = F.col("__v"), F.col("__rank")
    bounds = _join_groups(rows, broadcast_if_small(groups), keys, "inner").groupBy(
        *map(named, [*keys, "__rank"])
    )
    state = cut_lineage(
        bounds.agg(
            F.min(value).alias("__lo"),
            F.max(value).alias("__hi"),
            F.count(value).alias("__inside"),
            F.lit(0).cast("bigint").alias("__below"),
            F.approx_count_distinct(value).alias("__different"),
        )
    )

    def candidates(current: DataFrame) -> DataFrame:
        joined = _join_groups(rows, broadcast_if_small(current), keys, "inner")
        return joined.where(value.between(F.col("__lo"), F.col("__hi")))

    carried = ["__rank", "__lo", "__hi", "__inside", "__below"]
    while not state.where(F.col("__different") > limit).isEmpty():
        grid = [i / _GRID for i in range(_GRID + 1)]
        sketched = (
            candidates(state)
            .groupBy(*map(named, [*keys, *carried]))
            .agg(F.percentile_approx(value, grid, _ACCURACY).alias("__grid"))
        )
        cell = F.floor((rank - F.col("__below")) / F.col("__inside") * _GRID).cast("int")
        cut = cut_lineage(
            sketched.withColumn("__a", F.get("__grid", F.greatest(cell - 2, F.lit(0))))
            .withColumn("__b", F.get("__grid", F.least(cell + 2, F.lit(_GRID))))
            .drop("__grid")
        )
        low, high = F.col("__a"), F.col("__b")
        # Five cells, in value order. The grid values have cells of their own, so that a value
        # repeated very often cannot stop the interval from shrinking.
        cells = {
            "under": value < low,
            "low": value == low,
            "inner": (value > low) & (value < high),
            "high": (value == high) & (high > low),
            "over": value > high,
        }
        measured = []
        for name, inside in cells.items():
            measured += [
                F.count_if(inside).alias(f"{name}_rows"),
                F.min(F.when(inside, value)).alias(f"{name}_min"),
                F.max(F.when(inside, value)).alias(f"{name}_max"),
                F.approx_count_distinct(F.when(inside, value)).alias(f"{name}_different"),
            ]
        counted = (
            candidates(cut).groupBy(*map(named, [*keys, *carried, "__a", "__b"])).agg(*measured)
        )
        # The one cell in which the running row count reaches the rank.
        chosen: Column | None = None
        passed = F.col("__below")
        for name in cells:
            rows_in = F.col(f"{name}_rows")
            described = F.struct(
                F.col(f"{name}_min").alias("lo"),
                F.col(f"{name}_max").alias("hi"),
                rows_in.alias("inside"),
                passed.alias("below"),
                F.col(f"{name}_different").alias("different"),
            )
            reached = rank <= passed + rows_in
            chosen = F.when(reached, described) if chosen is None else chosen.when(reached, described)
            passed = passed + rows_in
        state = cut_lineage(
            counted.withColumn("__cell", chosen).select(
                *map(named, keys),
                rank,
                *(
                    F.col("__cell").getField(part).alias(f"__{part}")
                    for part in ("lo", "hi", "inside", "below", "different")
                ),
            )
        )

    repeated = (
        candidates(state)
        .groupBy(*map(named, [*keys, "__rank", "__below", "__v"]))
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    upto = F.sum("__times").over(Window.partitionBy(*map(named, keys)).orderBy("__v"))
    position = rank - F.col("__below")
    return (
        repeated.withColumn("__upto", upto)
        .where((position <= F.col("__upto")) & (position > F.col("__upto") - F.col("__times")))
        .select(*map(named, keys), value.alias(out))
    )


def group_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    *,
    lower: bool = True,
    hot_rows: int | None = HOT_GROUP_ROWS,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact median of ``value`` per group; NULL for a group without values.

    ``lower`` takes the lower of the two middle values of an even count, otherwise they are
    averaged. ``totals`` are further aggregates of the same groups, computed in the same pass.

    Calling this counts the groups, a job of its own over the key and the value; only groups above
    ``hot_rows`` pay for the narrowing rounds, which read the values of those groups from a table
    written once. With ``hot_rows=None`` nothing is counted: for groups known to be small.
    """
    totals = totals or {}
    data = df.withColumn("__v", named(value).cast("double"))
    if hot_rows is None:
        return _direct(data, keys, "__v", out, lower, totals)
    sizes = data.groupBy(*map(named, keys)).agg(F.count("__v").alias("__n"))
    if sizes.where(F.col("__n") > hot_rows).isEmpty():
        return _direct(data, keys, "__v", out, lower, totals)

    hot = cut_lineage(sizes.where(F.col("__n") > hot_rows))
    small = broadcast_if_small(hot)
    ordinary = _join_groups(data, small, keys, "left_anti")
    large = _join_groups(data, small, keys, "left_semi")
    rows = written(large.where(F.col("__v").isNotNull()).select(*map(named, keys), "__v"))

    def at(rank: Column, name: str) -> DataFrame:
        ranked = hot.select(*map(named, keys), rank.cast("bigint").alias("__rank"))
        return _select_rank(rows, ranked, keys, name, hot_rows)

    size = F.col("__n")
    answer = at(F.floor((size + 1) / 2), out)
    if not lower:
        upper = at(F.floor(size / 2) + 1, "__upper")
        answer = _join_groups(answer, upper, keys, "inner").select(
            *map(named, keys), ((named(out) + F.col("__upper")) / 2).alias(out)
        )
    if totals:
        summed = large.groupBy(*map(named, keys)).agg(
            *(c.alias(name) for name, c in totals.items())
        )
        answer = _join_groups(answer, summed, keys, "inner")
    return _direct(ordinary, keys, "__v", out, lower, totals).unionByName(answer)


def top_k_mean(df: DataFrame, keys: Sequence[str], value: str, out: str, k: int = 3) -> DataFrame:
    """Mean of the ``k`` largest values per group (of all, if fewer); 0.0 without values.

    The rank filter is applied on both sides of the shuffle, so a task sends at most ``k`` rows
    per group.
    """
    place = F.row_number().over(
        Window.partitionBy(*map(named, keys)).orderBy(named(value).desc_nulls_last())
    )
    return (
        df.select(*map(named, keys), named(value))
        .withColumn("__place", place)
        .where(F.col("__place") <= k)
        .groupBy(*map(named, keys))
        .agg(F.coalesce(F.avg(named(value)), F.lit(0.0)).alias(out))
    )


def first_last(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    first: Sequence[str] = (),
    last: Sequence[str] = (),
) -> DataFrame:
    """Values on the first and on the last row of each group, without a global sort.

    The picked columns are part of the ordering, so that tied rows give one definite answer and
    all columns of one end come from the same row.
    """
    start = F.min(F.struct(*map(named, [*order, *first])))
    end = F.max(F.struct(*map(named, [*order, *last])))
    ends = df.groupBy(named(key)).agg(start.alias("__start"), end.alias("__end"))
    return ends.select(
        named(key),
        *(F.col("__start").getField(c).alias(f"{c}_FIRST") for c in first),
        *(F.col("__end").getField(c).alias(f"{c}_LAST") for c in last),
    )


#: Bits that hold a whole number of a type and one value more, for NULL.
_WIDTHS = {"tinyint": 9, "smallint": 17, "int": 33, "bigint": 65, "date": 33}


def packed_order(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One decimal that sorts like the columns in turn, NULL first; None if they do not fit into one.

    A decimal is a value of fixed size, which a hash aggregation can keep; a struct is not, and makes
    Spark sort the rows on both sides of the shuffle.
    """
    kinds = dict(df.dtypes)
    widths = [_WIDTHS.get(kinds[name]) for name in order]
    if None in widths or sum(widths) > 126:
        return None
    packed = F.lit(0).cast("decimal(38,0)")
    for name, bits in zip(order, widths):
        number = named(name)
        if kinds[name] == "date":
            number = F.unix_date(number)
        above_null = number.cast("decimal(38,0)") + F.lit(str(2 ** (bits - 2) + 1)).cast("decimal(38,0)")
        digit = F.coalesce(above_null, F.lit(0).cast("decimal(38,0)"))
        packed = packed * F.lit(str(2**bits)).cast("decimal(38,0)") + digit
    return packed.cast("decimal(38,0)")


def latest_value(
    df: DataFrame, key: str, value: str, order: Sequence[str], out: str
) -> DataFrame:
    """The value on the last row of each group, NULL if that row has none."""
    packed = packed_order(df, order)
    place = F.struct(*map(named, order)) if packed is None else packed
    return df.groupBy(named(key)).agg(F.max_by(named(value), place).alias(out))


register("median", Aggregate("MEDIAN", execution="ranked", operator=partial(group_median, lower=False)))
register("median_lower", Aggregate("MEDIAN", execution="ranked", empty=0.0, operator=group_median))
register("top3", Aggregate("TOP3", execution="ranked", empty=0.0, operator=top_k_mean))
