"""Row-level column builders: ratios, indicators, missing values, encodings, row statistics.

Every builder takes and returns ``Column`` objects, so the result stays inside Catalyst. Column
names may hold blanks, dots or colons; :func:`named` quotes them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def named(name: ColumnLike) -> Column:
    """The column called exactly ``name``, whatever characters the name holds."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


# --- arithmetic -----------------------------------------------------------------------------


def difference(left: ColumnLike, right: ColumnLike) -> Column:
    return named(left) - named(right)


def safe_ratio(numerator: ColumnLike, divisor: ColumnLike) -> Column:
    """``numerator / divisor``; NULL when either is NULL or the divisor is zero."""
    return F.try_divide(named(numerator).cast("double"), named(divisor).cast("double"))


def simple_interest(annuity: ColumnLike, credit: ColumnLike, payments: ColumnLike) -> Column:
    """Interest per instalment: the annuity's share of the credit, less an equal share."""
    return safe_ratio(annuity, credit) - safe_ratio(F.lit(1), payments)


def row_sum(columns: Sequence[ColumnLike]) -> Column:
    """Sum across columns; NULL as soon as one of them is NULL."""
    return reduce(add, map(named, columns))


# --- indicators and casts -------------------------------------------------------------------


def indicator(condition: Column) -> Column:
    """1 / 0 / NULL for a true / false / unknown condition."""
    return condition.cast("int")


def truthy(value: ColumnLike) -> Column:
    """1 for any non-zero number, 0 for zero, NULL for NULL."""
    return named(value).cast("boolean").cast("int")


def lenient_cast(value: ColumnLike, to: str) -> Column:
    """Cast that yields NULL where the text does not parse."""
    return named(value).try_cast(to)


def within_trailing(offset: ColumnLike, length: int, *, inclusive: bool = True) -> Column:
    """True when a non-positive day or month offset lies in the last ``length`` units."""
    column = named(offset)
    return column >= -length if inclusive else column > -length


# --- missing values -------------------------------------------------------------------------


def without_sentinel(value: ColumnLike, sentinel: int | float) -> Column:
    """The value, with the sentinel read as NULL."""
    return F.nullif(named(value), F.lit(sentinel))


def text_is_missing(value: ColumnLike) -> Column:
    """True for NULL, blank text and the literal text ``null``; never NULL itself."""
    return F.coalesce(F.trim(named(value)).isin("", "null"), F.lit(True))


def text_or_null(value: ColumnLike) -> Column:
    """The text, with every missing marker turned into NULL."""
    return F.when(~text_is_missing(value), named(value))


# --- encodings ------------------------------------------------------------------------------


def one_hot(
    column: str, categories: Iterable[str], *, null_as_zero: bool, prefix: str | None = None
) -> dict[str, Column]:
    """One 0/1 flag per category, keyed ``<prefix>_<category>`` and ready for ``withColumns``.

    ``null_as_zero`` decides what a NULL category means: all flags 0 (so that it counts in a
    mean) or all flags NULL (so that a mean skips it).
    """
    source = named(column)
    flags = {}
    for category in categories:
        matches = source == F.lit(category)
        if null_as_zero:
            matches = F.coalesce(matches, F.lit(False))
        flags[f"{column if prefix is None else prefix}_{category}"] = matches.cast("int")
    return flags


# Upper bound of the age (exclusive) and the label of the band.
AGE_BANDS = ((27, 1), (40, 2), (50, 3), (65, 4), (99, 5))


def age_band(days_since_birth: ColumnLike) -> Column:
    """Age label from a negative day count; 0 beyond the last band, NULL for NULL."""
    days = named(days_since_birth).cast("bigint")
    label = F.when(days.isNull(), F.lit(None).cast("int"))
    # Whole years, truncated toward zero, are below N exactly when the days are below N * 365.
    for years, value in AGE_BANDS:
        label = label.when(-days < years * 365, value)
    return label.otherwise(0)


# --- statistics across the columns of one row -----------------------------------------------


def row_min(columns: Sequence[ColumnLike]) -> Column:
    return F.least(*map(named, columns))


def row_max(columns: Sequence[ColumnLike]) -> Column:
    return F.greatest(*map(named, columns))


def row_count(columns: Sequence[ColumnLike]) -> Column:
    """How many of the columns are not NULL."""
    return reduce(add, (named(c).isNotNull().cast("int") for c in columns))


def row_mean(columns: Sequence[ColumnLike]) -> Column:
    total = reduce(add, (F.coalesce(named(c).cast("double"), F.lit(0.0)) for c in columns))
    return F.try_divide(total, row_count(columns).cast("double"))


def row_product(columns: Sequence[ColumnLike]) -> Column:
    """Product across columns; NULL as soon as one of them is NULL."""
    return reduce(mul, map(named, columns))


def row_weighted_sum(columns: Sequence[ColumnLike], weights: Sequence[float]) -> Column:
    """Weighted sum across columns; NULL as soon as one of them is NULL."""
    return reduce(add, (named(c) * weight for c, weight in zip(columns, weights, strict=True)))


def row_median(columns: Sequence[ColumnLike]) -> Column:
    """Median of the non-NULL columns; the two middles are averaged for an even count."""
    present = F.array_sort(F.array_compact(F.array(*(named(c).cast("double") for c in columns))))
    size = F.size(present)
    lower = F.get(present, F.floor((size - 1) / 2).cast("int"))
    upper = F.get(present, F.floor(size / 2).cast("int"))
    return F.when(size % 2 == 1, upper).otherwise((lower + upper) / 2)


def row_var_pop(columns: Sequence[ColumnLike]) -> Column:
    """Population variance of the non-NULL columns."""
    mean = row_mean(columns)
    squares = (
        F.coalesce((named(c).cast("double") - mean) * (named(c).cast("double") - mean), F.lit(0.0))
        for c in columns
    )
    return F.try_divide(reduce(add, squares), row_count(columns).cast("double"))
