"""Reading input tables: CSV with declared or inferred types, and run-dated Parquet."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from creditloom.functions.scalar import named
from creditloom.schemas import TABLES

RUN_DATE = "run_date"


def first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """The first line that is not blank of every text file with one, by file; one job for all files.

    A line of a file's first block is looked at, no other; the earliest is kept by aggregation.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start"
    )
    opening = (
        lines.where("file_block_start = 0")
        .where(F.trim("value") != "")
        .withColumn("at", F.monotonically_increasing_id())
    )
    # the empty set makes Spark keep texts in a hash aggregation, where it would sort all lines;
    # it has to be part of the result for that
    first = opening.groupBy("file").agg(
        F.min_by("value", "at").alias("line"), F.collect_set(F.lit(None).cast("int")).alias("none")
    )
    return {row.file: row.line for row in first.collect()}


Layouts = dict[tuple[str, ...], list[str]]


def layouts_of(spark: SparkSession, path: str, sep: str = ",", same: bool = False) -> Layouts:
    """Files by their header. ``same`` takes the header of one file for that of all."""
    found = {}
    if same:
        for file in sorted(spark.read.text(path).inputFiles()):
            found = first_lines(spark, file)
            if found:
                header = next(csv.reader([next(iter(found.values()))], delimiter=sep))
                return {tuple(header): [path]}
        return {}
    layouts: Layouts = {}
    for file, line in sorted(first_lines(spark, path).items()):
        layouts.setdefault(tuple(next(csv.reader([line], delimiter=sep))), []).append(file)
    return layouts


REJECTED = "__rejected"


def _typed(
    spark: SparkSession,
    header: tuple[str, ...],
    files: list[str],
    schema: StructType,
    sep: str,
    strict: bool,
    rejects: bool,
) -> DataFrame:
    """Files of one header in the declared columns."""
    declared = {field.name: field for field in schema.fields}
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{files[0]} lacks the columns {missing}")
    layout = StructType([declared.get(n, StructField(n, StringType(), True)) for n in header])
    corrupt = "__corrupt"
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("enforceSchema", False)
    )
    if not rejects:
        return reader.schema(layout).csv(files).select(*map(named, declared))
    reader = reader.option("columnNameOfCorruptRecord", corrupt)
    rows = reader.schema(layout.add(corrupt, StringType())).csv(files)
    # only lines with a bad value are read a second time, as texts
    texts = ", ".join(f"`c{i}` STRING" for i in range(len(header)))
    parsed = F.from_csv(F.col(corrupt), F.lit(texts), {"sep": sep})
    bad = [
        F.when(named(name).isNull() & (F.col("__text").getField(f"c{i}") != ""), F.lit(name))
        for i, name in enumerate(header)
        if name in declared
    ]
    names = F.filter(F.array(*bad), lambda name: name.isNotNull())
    return rows.withColumn("__text", F.when(F.col(corrupt).isNotNull(), parsed)).select(
        *map(named, declared), F.when(F.col(corrupt).isNotNull(), names).alias(REJECTED)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    sep: str = ",",
    by_position: bool = False,
    strict: bool = False,
    same_header: bool = False,
    observed: Observation | None = None,
) -> DataFrame:
    """Read CSV files with a header each into the declared columns, or into inferred ones.

    Each file's own header decides where its columns stand, so files may hold more columns than the
    schema, in any order, also different ones. One job finds the headers of all files; files of
    equal headers are read together, and Spark compares header and layout once more while reading.
    ``same_header`` spares that job: the header of one file is taken, and another one is an error.
    A value that does not parse becomes NULL, or fails the query if ``strict``. ``by_position``
    ignores the header names and takes the columns as they come.

    ``observed`` counts in the same pass, whenever the result is first computed: ``rows``, and for
    each column the values that became NULL because they did not parse.
    """
    if by_position:
        if schema is None or observed is not None:
            raise ValueError("columns by position need a schema and are not observed")
        mode = "FAILFAST" if strict else "PERMISSIVE"
        reader = spark.read.option("header", True).option("sep", sep).option("mode", mode)
        return reader.schema(schema).csv(path)
    layouts = layouts_of(spark, path, sep, same_header)
    if schema is None:
        schema = _inferred(spark, layouts, sep)
        wanted = {header: StructType([schema[name] for name in header]) for header in layouts}
    else:
        wanted = dict.fromkeys(layouts, schema)
    parts = [
        _typed(spark, header, files, wanted[header], sep, strict, observed is not None)
        for header, files in sorted(layouts.items())
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    if observed is not None:
        counts = [
            F.count_if(F.array_contains(REJECTED, F.lit(name))).alias(name) for name in schema.names
        ]
        rows = rows.observe(observed, F.count(F.lit(1)).alias("rows"), *counts)
    return rows.select(*map(named, schema.names))


# --- inferred types -------------------------------------------------------------------------

#: Kinds of values, each a bit; what a column holds is the set of its values' kinds.
INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(7))


def kind_of(value: Column) -> Column:
    """The narrowest kind that takes a text; 0 for a missing or blank one."""
    trimmed = F.trim(value)
    whole = F.when(trimmed.try_cast("int").isNotNull(), INT).when(
        trimmed.try_cast("bigint").isNotNull(), LONG
    )
    day = r"^\d{4}-\d{2}-\d{2}$"
    moment = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?$"
    return (
        F.when(value.isNull() | (trimmed == ""), 0)
        .when(trimmed.rlike(r"^[+-]?\d+$"), whole.otherwise(DOUBLE))
        .when(trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), DOUBLE)
        .when(trimmed.rlike(day) & trimmed.try_cast("date").isNotNull(), DATE)
        .when(trimmed.rlike(moment) & trimmed.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(trimmed).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def join_of(kinds: int) -> DataType:
    """The narrowest type that takes all kinds of a set; text for an empty one."""
    for type_, allowed in (
        (IntegerType(), INT),
        (LongType(), INT | LONG),
        (DoubleType(), INT | LONG | DOUBLE),
        (DateType(), DATE),
        (TimestampType(), DATE | TIMESTAMP),
        (BooleanType(), BOOLEAN),
    ):
        if kinds and not kinds & ~allowed:
            return type_
    return StringType()


def infer_schema(spark: SparkSession, path: str, *, sep: str = ",") -> StructType:
    """The columns of all files together, each with the narrowest type that takes all its values.

    One job finds the headers, one reads all files: the kinds of a column's values are or-ed, which
    starts in every task. Columns stand in the order in which the headers first name them.
    """
    return _inferred(spark, layouts_of(spark, path, sep), sep)


def _inferred(spark: SparkSession, layouts: Layouts, sep: str) -> StructType:
    names = list(dict.fromkeys(name for header in sorted(layouts) for name in header))
    if not names:
        return StructType([])
    parts = []
    for header, files in sorted(layouts.items()):
        texts = StructType([StructField(name, StringType()) for name in header])
        rows = spark.read.option("header", True).option("sep", sep).schema(texts).csv(files)
        parts.append(rows.select(*(kind_of(named(name)).alias(name) for name in header)))
    kinds = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    found = kinds.agg(*(F.bit_or(named(name)).alias(name) for name in names)).first()
    return StructType([StructField(n, join_of(k or 0)) for n, k in zip(names, found)])


def read_run_csv(
    spark: SparkSession, root: str, table: str, run_date: str, **options: object
) -> DataFrame:
    """Read the CSV delivery ``<root>/<table>_<run date>.csv`` of a known credit table."""
    return read_csv(spark, f"{root}/{table}_{run_date}.csv", TABLES[table], **options)


def read_run(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """Read one run of a Parquet table partitioned by run date; other runs are not opened."""
    return spark.read.parquet(path).where(F.col(RUN_DATE) == F.lit(run_date)).drop(RUN_DATE)

