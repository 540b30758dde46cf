"""What the operators of this folder share: words, null texts, Arrow batches, folders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = b" \t\n\x0b\x0c\r"

#: The same as a pattern, and a word: a longest run of anything else.
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, function, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a function from record batches to column mappings.

    ``function(batches)`` yields mappings from column name to a list or array; they become record
    batches of ``schema``.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield record_batch(columns, arrow)

    return df.mapInArrow(run, struct)


def record_batch(columns: Mapping[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    """Columns, given as lists or arrays, as one batch of the given schema."""
    arrays = []
    for field in schema:
        values = columns[field.name]
        if not isinstance(values, pa.Array):
            values = pa.array(values, type=field.type)
        arrays.append(values if values.type == field.type else values.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column, an empty one for null."""
    return [text or "" for text in column.to_pylist()]


def quoted(*names: str) -> list[Column]:
    """Columns by their exact names, whatever characters these hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def rest_of(df: DataFrame, *without: str) -> Column:
    """All other columns of a row as one struct, so that their names clash with nothing."""
    others = [name for name in df.columns if name not in without]
    return F.struct(*quoted(*others)) if others else F.struct(F.lit(None).alias("none"))


def restored(df: DataFrame, like: DataFrame, struct: str, **values: Column) -> DataFrame:
    """The columns of ``like``, taken from a struct made by :func:`rest_of` or given by name."""
    return df.select(
        *(
            values.get(name, F.col(struct).getField(name)).alias(name)
            for name in like.columns
        )
    )
