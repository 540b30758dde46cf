"""Published tables: rows by key, in snapshots that a manifest describes.

Rows are stored by a hash of their key in ``key_bucket=<n>/snapshot=<folder>``. A publish rewrites the
buckets it has keys in, into folders of its own, and then puts its manifest in place: a small file
that names, for every bucket, the folder with its current rows. Folders are never changed once a
manifest names them. So a reader sees a whole snapshot or none of it; it opens one manifest and the
folders named there, however many snapshots there are. Manifests are few and small: one line for
each bucket.

Next to each row stand two 64-bit digests of what is published with the key. They tell the rows that
differ between two snapshots (:func:`changes`) without reading the rows themselves, and only in the
buckets for which the two manifests name different folders.

:func:`retain` drops old snapshots, :func:`rebucket` lays a snapshot out anew when the table has
outgrown its buckets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditloom.functions.scalar import named
from creditloom.sources.files import Folder

BUCKET, SNAPSHOT = "key_bucket", "snapshot"
MANIFESTS = "_manifests"
DIGESTS = ("row_digest_1", "row_digest_2")


def merge_latest(
    published: DataFrame | None, batch: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """The published rows with a new batch laid over them: per key the highest version wins.

    On equal versions the batch wins, so that merging a batch twice changes nothing. Rows of a batch
    that agree in key and version are told apart by their content, so that the outcome does
    not depend on where they are read.
    """
    both = batch.withColumn("__new", F.lit(1))
    if published is not None:
        both = published.withColumn("__new", F.lit(0)).unionByName(both)
    newest = Window.partitionBy(*map(named, keys)).orderBy(
        named(version).desc_nulls_last(),
        F.col("__new").desc(),
        F.xxhash64(*map(named, sorted(batch.columns))),
    )
    return (
        both.withColumn("__place", F.row_number().over(newest))
        .where(F.col("__place") == 1)
        .drop("__place", "__new")
    )


# --- manifests ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """One snapshot: how its rows are laid out, and for each bucket with rows the folder of them."""

    snapshot: str
    keys: tuple[str, ...]
    version: str
    buckets: int
    #: published columns, as Spark's JSON
    columns: str
    current: dict[int, str]

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.columns))

    def text(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        current = {int(bucket): folder for bucket, folder in found["current"].items()}
        return Manifest(**{**found, "keys": tuple(found["keys"]), "current": current})


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Names of the snapshots of a published table, oldest first."""
    names = Folder(spark, root).names(MANIFESTS)
    return [name.removesuffix(".json") for name in names if name.endswith(".json")]


def manifest(
    spark: SparkSession, root: str, upto: str | None = None, *, before: bool = False
) -> Manifest | None:
    """The newest snapshot's manifest, or that of the newest up to (or ``before``) a name."""
    names = [
        name
        for name in snapshots(spark, root)
        if upto is None or name < upto or (name == upto and not before)
    ]
    if not names:
        return None
    return Manifest.of(Folder(spark, root).read(f"{MANIFESTS}/{names[-1]}.json"))


def _rows(
    spark: SparkSession, root: str, found: Manifest, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The rows of a snapshot with their digests, of all or of some buckets."""
    schema = found.schema()
    for name in DIGESTS:
        schema = schema.add(name, "long")
    chosen = found.current if buckets is None else set(buckets) & set(found.current)
    paths = [f"{root}/{BUCKET}={b}/{SNAPSHOT}={found.current[b]}" for b in sorted(chosen)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame:
    """The published rows as of a snapshot (the newest)."""
    root = root.rstrip("/")
    found = manifest(spark, root, snapshot)
    if found is None:
        raise ValueError(f"nothing is published at {root}")
    return _rows(spark, root, found).drop(*DIGESTS)


# --- publishing -----------------------------------------------------------------------------


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*map(named, keys)), F.lit(buckets)).cast("int")


def _with_digests(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Digests of all columns but keys and version, as text, in which NULL differs from any value."""
    content = sorted(set(df.columns) - {*keys, version})
    text = F.to_json(F.struct(*map(named, content)), {"ignoreNullFields": "false"}) if content else F.lit("")
    hashes = F.xxhash64(text), F.xxhash64(F.lit("second"), text)
    return df.withColumns(dict(zip(DIGESTS, hashes)))


def _store(rows: DataFrame, root: str, found: Manifest, folder: str) -> None:
    (
        _with_digests(rows, found.keys, found.version)
        .withColumn(BUCKET, _bucket(found.keys, found.buckets))
        .withColumn(SNAPSHOT, F.lit(folder))
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET, SNAPSHOT)
        .parquet(root)
    )


def _new_folder(spark: SparkSession, root: str, snapshot: str) -> str:
    """A folder name that no manifest has: a repeated run leaves the rows of the first in place."""
    used = 0
    for name in snapshots(spark, root):
        if name >= snapshot:
            folders = Manifest.of(Folder(spark, root).read(f"{MANIFESTS}/{name}.json")).current
            for folder in folders.values():
                base, _, attempt = folder.partition("~")
                if base == snapshot:
                    used = max(used, int(attempt or 0) + 1)
    return f"{snapshot}~{used}" if used else snapshot


def publish(
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    version: str,
    *,
    snapshot: str,
    buckets: int = 64,
    full: bool = False,
) -> Manifest:
    """Lay a batch over what is published, as snapshot ``snapshot``; ``full`` replaces everything.

    Only the buckets that the batch has keys in are read and written. Snapshots sort by name. A run
    that is repeated starts from the snapshot before it and replaces its own; snapshots published
    after it stay as they are. ``buckets`` counts for the first snapshot and for full ones; later
    ones keep the number of those before them.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    parent = manifest(spark, root, snapshot, before=True)
    columns = batch.schema.json()
    if parent is not None and not full:
        if parent.keys != tuple(keys) or parent.version != version:
            raise ValueError(f"{root} is published by {parent.keys} and {parent.version}")
        if sorted(batch.columns) != sorted(parent.schema().names):
            raise ValueError(f"{root} is published with other columns")
        buckets, columns = parent.buckets, parent.columns
    found = Manifest(snapshot, tuple(keys), version, buckets, columns, {})
    folder = _new_folder(spark, root, snapshot)
    # as many rows as there are buckets
    touched = [
        row[0] for row in batch.select(_bucket(keys, buckets).alias(BUCKET)).distinct().collect()
    ]
    published = None
    if parent is not None and not full:
        published = _rows(spark, root, parent, touched).drop(*DIGESTS)
        batch = batch.select(*map(named, parent.schema().names))
    if touched:
        _store(merge_latest(published, batch, keys, version), root, found, folder)
    kept = parent.current if parent is not None and not full else {}
    return _put(spark, root, found, {**kept, **dict.fromkeys(touched, folder)})


def _put(spark: SparkSession, root: str, found: Manifest, current: dict[int, str]) -> Manifest:
    found = Manifest(**{**asdict(found), "keys": found.keys, "current": dict(sorted(current.items()))})
    Folder(spark, root).replace(f"{MANIFESTS}/{found.snapshot}.json", found.text())
    return found


def rebucket(spark: SparkSession, root: str, *, snapshot: str, buckets: int) -> Manifest:
    """The newest rows laid out in another number of buckets, as a snapshot of their own.

    For tables that have outgrown their buckets; small files of a bucket become one on the way.
    """
    found = manifest(spark, root)
    if found is None or found.snapshot >= snapshot:
        raise ValueError(f"{snapshot} does not come after what is published at {root}")
    rows = read_published(spark, root)
    return publish(rows, root, found.keys, found.version, snapshot=snapshot, buckets=buckets, full=True)


def retain(spark: SparkSession, root: str, newest: int) -> list[str]:
    """Drop all but the newest snapshots; the names of those dropped.

    Manifests go first, so that no snapshot is seen without its rows; then the folders that no
    remaining manifest names. Folders of snapshots later than all manifests stay: they belong to a
    publish under way.
    """
    if newest < 1:
        raise ValueError("at least one snapshot stays")
    folder, names = Folder(spark, root), snapshots(spark, root)
    dropped, kept = names[:-newest], names[-newest:]
    if not kept:
        return []
    for name in dropped:
        folder.delete(f"{MANIFESTS}/{name}.json")
    used = set()
    for name in kept:
        current = Manifest.of(folder.read(f"{MANIFESTS}/{name}.json")).current
        used |= {f"{BUCKET}={b}/{SNAPSHOT}={stored}" for b, stored in current.items()}
    for bucket in folder.names(folders=True):
        if not bucket.startswith(f"{BUCKET}="):
            continue
        for stored in folder.names(bucket, folders=True):
            name = stored.removeprefix(f"{SNAPSHOT}=").partition("~")[0]
            if f"{bucket}/{stored}" not in used and name <= kept[-1]:
                folder.delete(f"{bucket}/{stored}")
    return dropped


# --- changes --------------------------------------------------------------------------------

INSERTED, CHANGED, REMOVED = "inserted", "changed", "removed"


def changed_keys(spark: SparkSession, root: str, before: str, after: str) -> DataFrame:
    """Keys whose rows differ between two snapshots, with ``change``: inserted, changed or removed.

    Keys and digests alone are read, of the buckets whose folders differ. Both sides meet in one
    aggregation by key, which takes NULL keys as equal. A new version of the same content is
    no change.
    """
    root = root.rstrip("/")
    old, new = (_exactly(spark, root, name) for name in (before, after))
    if old.keys != new.keys:
        raise ValueError(f"{before} and {after} have different keys")
    sides = []
    for found, other, side in ((old, new, 0), (new, old, 1)):
        rows = _rows(spark, root, found, _differing(found, other))
        digests = [
            (F.col(name) if at == side else F.lit(None).cast("long")).alias(f"{name}_{at}")
            for at in (0, 1)
            for name in DIGESTS
        ]
        sides.append(rows.select(*map(named, new.keys), *digests))
    met = sides[0].unionByName(sides[1]).groupBy(*map(named, new.keys))
    held = [f"{name}_{at}" for at in (0, 1) for name in DIGESTS]
    both = met.agg(*(F.max(name).alias(name) for name in held))
    first = F.col(f"{DIGESTS[0]}_0"), F.col(f"{DIGESTS[0]}_1")
    differs = F.lit(False)
    for name in DIGESTS:
        differs = differs | (F.col(f"{name}_0") != F.col(f"{name}_1"))
    change = F.when(first[0].isNull(), INSERTED).when(first[1].isNull(), REMOVED).when(differs, CHANGED)
    return both.withColumn("change", change).where("change IS NOT NULL").drop(*held)


def changes(spark: SparkSession, root: str, before: str, after: str) -> DataFrame:
    """The changed keys with ``change`` and the columns they have now, NULL for removed ones."""
    root = root.rstrip("/")
    new, old = _exactly(spark, root, after), _exactly(spark, root, before)
    rows = _rows(spark, root, new, _differing(new, old)).drop(*DIGESTS)
    keys = changed_keys(spark, root, before, after).withColumnsRenamed(
        {name: f"__key_{name}" for name in new.keys}
    )
    same = F.lit(True)
    for name in new.keys:
        same = same & named(name).eqNullSafe(named(f"__key_{name}"))
    rest = [name for name in rows.columns if name not in new.keys]
    return keys.join(rows, same, "left").select(
        *(named(f"__key_{name}").alias(name) for name in new.keys), "change", *map(named, rest)
    )


def _exactly(spark: SparkSession, root: str, snapshot: str) -> Manifest:
    found = manifest(spark, root, snapshot)
    if found is None or found.snapshot != snapshot:
        raise ValueError(f"{root} has no snapshot {snapshot}")
    return found


def _differing(found: Manifest, other: Manifest) -> list[int] | None:
    """Buckets whose rows may differ; None for all."""
    if found.buckets != other.buckets:
        return None
    return [b for b, folder in found.current.items() if other.current.get(b) != folder]
