"""Deliveries stored by client, so that joins and aggregations on the client need no shuffle.

The feature jobs join and group the same child tables on the same key, every day. A delivery that is
stored in buckets of that key, sorted into the same number of buckets as the other tables, is read
as it is partitioned: grouping by the key, windows over it, and joins of two such tables run without
an exchange.

A bucket is read by one task, and AQE cannot split it. So the rows of hot keys, and those without a
key, are not put into buckets: they lie next to them as a plain table, which goes through the
ordinary plans with their partial aggregates and splittable joins. A key is in one of the two
tables, never in both, so results of the two are put together by a union.

A small file names both tables; it is replaced in one step, so that a repeated delivery is seen
whole or not at all. The bucketed table is registered in the session's catalog, under a name made
from its folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditloom.functions.scalar import named
from creditloom.operators.relational import broadcast_if_small
from creditloom.session import cut_lineage
from creditloom.sources.files import Folder

LAYOUT = "_layout.json"

#: Keys with more rows than this are not put into a bucket.
HOT_KEY_ROWS = 5_000_000


@dataclass(frozen=True)
class Stored:
    """A stored delivery: ``rows`` in buckets of ``key``, and the rows of ``hot`` keys, if any."""

    key: str
    buckets: int
    rows: DataFrame
    hot: DataFrame | None

    def everything(self) -> DataFrame:
        return self.rows if self.hot is None else self.rows.unionByName(self.hot)

    def derive(
        self,
        bucketed: Callable[[DataFrame], DataFrame],
        plain: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Results per key: ``bucketed`` of the buckets, ``plain`` (or the same) of the hot keys.

        The functions give rows for keys from nothing but the rows of these keys.
        """
        found = bucketed(self.rows)
        return found if self.hot is None else found.unionByName((plain or bucketed)(self.hot))


def store(
    df: DataFrame,
    root: str,
    key: str,
    *,
    buckets: int | None = None,
    sort: Sequence[str] = (),
    hot_rows: int = HOT_KEY_ROWS,
) -> Stored:
    """Store a delivery by ``key``; tables that are to meet need the same number of buckets.

    ``buckets`` is the session's number of shuffle partitions unless given. Calling this counts the
    keys, a job that reads the key column alone; then the rows are shuffled and written once.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.groupBy(named(key)).agg(F.count(F.lit(1)).alias("__rows"))
    # a row for each key with more than hot_rows rows
    apart = cut_lineage(sizes.where((F.col("__rows") > hot_rows) & named(key).isNotNull()).drop("__rows"))
    missing = not sizes.where(named(key).isNull()).isEmpty()
    ordinary, hot = df.where(named(key).isNotNull()), df.where(named(key).isNull())
    if not apart.isEmpty():
        apart = broadcast_if_small(apart)
        ordinary = ordinary.join(apart, key, "left_anti")
        hot = hot.unionByName(df.join(apart, key, "left_semi"))
    elif not missing:
        hot = None
    folder, name = Folder(spark, root), uuid.uuid4().hex
    before = json.loads(folder.read(LAYOUT)) if LAYOUT in folder.names() else None
    table = f"stored_{name}"
    (
        ordinary.select(*map(named, df.columns))
        .repartition(buckets, named(key))
        .write.bucketBy(buckets, key)
        .sortBy(key, *sort)
        .option("path", f"{root}/buckets-{name}")
        .saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")  # its files stay
    if hot is not None:
        hot.select(*map(named, df.columns)).write.parquet(f"{root}/hot-{name}")
    layout = {
        "key": key,
        "buckets": buckets,
        "sort": [key, *sort],
        "columns": df.schema.json(),
        "rows": f"buckets-{name}",
        "hot": f"hot-{name}" if hot is not None else None,
    }
    folder.replace(LAYOUT, json.dumps(layout))
    for old in (before["rows"], before["hot"]) if before else ():
        if old is not None:
            folder.delete(old)
    return open_stored(spark, root)


def open_stored(spark: SparkSession, root: str) -> Stored:
    """A delivery stored by :func:`store`, in this session or another."""
    root = root.rstrip("/")
    layout = json.loads(Folder(spark, root).read(LAYOUT))
    schema = StructType.fromJson(json.loads(layout["columns"]))
    place = f"{root}/{layout['rows']}"
    table = f"stored_{hashlib.md5(place.encode()).hexdigest()}"
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({_name(layout['key'])}) "
        f"SORTED BY ({', '.join(map(_name, layout['sort']))}) INTO {layout['buckets']} BUCKETS "
        f"LOCATION '{place}'"
    )
    hot = None
    if layout["hot"] is not None:
        hot = spark.read.schema(schema).parquet(f"{root}/{layout['hot']}")
    return Stored(layout["key"], layout["buckets"], spark.table(table), hot)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
