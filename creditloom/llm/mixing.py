"""Mixing sources to target weights along a curriculum whose weights change over time.

Each source has a schedule, a piecewise-linear weight over training time 0 to 1. Its integral is the
source's share of the whole mix. A share above ``max_epochs`` times what the source holds is cut to
that, and the excess goes to the others by weight. Cumulative demand up to a time is the integral
up to it; the k-th word that a source delivers is therefore due when its demand reaches k, and
inverting the integral gives a document its training position. Rows are range-sorted by position.

Everything is DataFrame and SQL functions. Running totals within a source are split into buckets
of a hash, so a source that holds most rows is spread over tasks: totals per bucket, a running
total over the buckets, then running totals inside each.

Defined results: null and wordless texts have size 0 and take part with nothing taken; sources are
ranked by code point with null last as a source of its own; ties in the order of documents are
broken by size, and rows that agree in id and size are interchangeable; an empty table gives an
empty mix. Other columns are kept by :func:`training_order` and ignored by :func:`mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import quoted, word_count
from creditloom.session import written

#: A schedule: (time, weight) points with times from 0 to 1.
Schedule = Sequence[tuple[float, float]]


def constant(weight: float) -> Schedule:
    return ((0.0, weight), (1.0, weight))


#: Constant weights 5, 2, 1, repeating over the sources.
STANDARD = (constant(5), constant(2), constant(1))


def integral(schedule: Schedule) -> float:
    """The area under a schedule."""
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(schedule, schedule[1:]))


def time_of(schedule: Schedule, area: Column) -> Column:
    """The time at which the integral of a schedule reaches ``area``."""
    done, answer = 0.0, F.lit(1.0)
    pieces = []
    for (a, v), (b, w) in zip(schedule, schedule[1:]):
        slope, rest = (w - v) / (b - a), area - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(v * v) + 2 * slope * rest, F.lit(0.0)))
        inside = F.lit(a) + F.try_divide(2 * rest, F.lit(v) + root)
        done += (b - a) * (v + w) / 2
        pieces.append((F.lit(done), F.least(inside, F.lit(b))))
    for limit, inside in reversed(pieces):
        answer = F.when(area <= limit, F.coalesce(inside, F.lit(0.0))).otherwise(answer)
    return answer


def source_targets(
    sizes: DataFrame, schedules: Sequence[Schedule], share: float, max_epochs: int
) -> DataFrame:
    """Per source: rank, words held, rows and target; one row per source, not per document.

    Below the level ``share * total / weights`` a source is full; the sources that fill up are the
    first ones by capacity per weight, so the level follows from running totals over the sources.
    """
    everything = Window.partitionBy()
    weights = F.array(*(F.lit(float(integral(s))) for s in schedules))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
        .withColumn("schedule", (F.col("rank") - 1) % len(schedules))
        .withColumn("weight", F.get(weights, F.col("schedule")))
        .withColumn("capacity", (max_epochs * F.col("source_size")).cast("double"))
    )
    by_fill = Window.orderBy(
        F.try_divide("capacity", "weight").asc_nulls_last(), F.col("rank")
    )
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.withColumn(
        "level",
        F.try_divide(
            F.lit(float(share)) * F.sum("source_size").over(everything)
            - F.coalesce(F.sum("capacity").over(before), F.lit(0.0)),
            F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        ),
    ).withColumn(
        "open", F.when(F.col("level") * F.col("weight") <= F.col("capacity"), F.col("level"))
    )
    # the first source that does not fill up sets the level of all that follow
    level = F.first("open", ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.select(
        "source",
        "rank",
        "schedule",
        "source_size",
        "source_rows",
        F.least(
            F.col("capacity"), F.coalesce(level * F.col("weight"), F.col("capacity"))
        ).alias("target"),
    )


def _measured(docs: DataFrame, doc_id: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")).alias("order"),
        *more,
    )


def _running(
    rows: DataFrame,
    sizes: DataFrame,
    schedules: Sequence[Schedule],
    share: float,
    max_epochs: int,
    rows_per_bucket: int,
) -> DataFrame:
    """``rows`` with their source's figures and the words of the source that come ``before`` them.

    ``sizes`` are the same rows without what is only carried along.
    """
    targets = source_targets(sizes, schedules, share, max_epochs)
    targets = targets.withColumnRenamed("source", "name")
    targets = F.broadcast(targets) if _few(targets) else targets
    hashed = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / float(1 << 32)
    bucket = F.floor(hashed * F.ceil(F.col("source_rows") / rows_per_bucket))

    def placed(df: DataFrame) -> DataFrame:
        return df.join(targets, F.col("source").eqNullSafe(F.col("name"))).withColumn(
            "bucket", bucket
        )

    starts = (
        placed(sizes)
        .groupBy("rank", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn(
            "start",
            F.sum("words").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("words"),
        )
        .select("rank", "bucket", "start")
    )
    inside = (
        Window.partitionBy("rank", "bucket")
        .orderBy("order", "size", "doc_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    epochs = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0))).cast("long")
    rest = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    return (
        placed(rows)
        .join(starts, ["rank", "bucket"])
        .withColumn("before", F.col("start") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("epochs", epochs)
        .withColumn("rest", rest)
    )


def _position(schedules: Sequence[Schedule], words: Column) -> Column:
    """The time at which a source's demand reaches ``words``."""
    area, position = F.try_divide(words, F.col("target")), F.lit(None).cast("double")
    for index, schedule in enumerate(schedules):
        due = time_of(schedule, area * F.lit(integral(schedule)))
        position = F.when(F.col("schedule") == index, due).otherwise(position)
    return position


def _few(targets: DataFrame, limit: int = 10_000) -> bool:
    """Whether the sources, counted now, are few enough to be sent to every task."""
    return targets.count() <= limit


def _by_position(df: DataFrame, *ties: Column) -> DataFrame:
    order = (F.asc_nulls_last("position"), *ties)
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = STANDARD,
    share: float = 1.0,
    max_epochs: int = 3,
    rows_per_bucket: int = 2000,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per row of ``docs``, what the mix takes of it and when, in training order.

    Every document is taken ``floor(target / source size)`` times; what is missing of the target
    goes once more to documents in hash order, the last of them with the words still missing.
    ``taken`` is in words, ``position`` the training time of the first copy (null if none).
    """
    sizes = written(_measured(docs, doc_id, text, source))
    running = _running(sizes, sizes, schedules, share, max_epochs, rows_per_bucket)
    missing = F.greatest(F.least(F.col("rest") - F.col("before"), F.col("size")), F.lit(0))
    taken = (F.col("epochs") * F.col("size") + missing).cast("long")
    mixed = running.withColumn("taken", taken).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.when(F.col("taken") > 0, _position(schedules, F.col("before"))).alias("position"),
    )
    return _by_position(mixed, F.col("doc_id"))


def training_order(
    docs: DataFrame,
    schedules: Sequence[Schedule] = STANDARD,
    share: float = 1.0,
    max_epochs: int = 3,
    rows_per_bucket: int = 2000,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, all columns kept, each as often as the mix takes it, by position.

    Documents are taken whole: the one in which the target is reached counts if that is nearer to
    the target. Wordless documents are not taken. Texts cross two shuffles, one by source and hash
    bucket and one by position.
    """
    sizes = written(_measured(docs, doc_id, text, source))
    rows = _measured(docs, doc_id, text, source, F.struct(*quoted(*docs.columns)).alias("row"))
    running = _running(rows, sizes, schedules, share, max_epochs, rows_per_bucket)
    once_more = (2 * (F.col("rest") - F.col("before")) >= F.col("size")).cast("int")
    copies = F.when(F.col("size") > 0, F.col("epochs").cast("int") + once_more).otherwise(0)
    each = running.withColumn(
        "copy", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)))
    )
    due = F.col("before") + F.col("copy") * F.col("source_size")
    placed = each.select("row", "order", "copy", _position(schedules, due).alias("position"))
    ordered = _by_position(placed, F.col("order"), F.col("copy"))
    return ordered.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
