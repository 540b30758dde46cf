"""Session construction and the one place where plan lineage is cut."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Largest number of rows and bytes a table may have (checked at run time) to be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

#: Rows for each file of narrow intermediate tables whose number of rows is bounded beforehand.
FILE_ROWS = 100_000

#: Scratch folders of sessions in local mode that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "creditloom", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **{name.replace("__", "."): value for name, value in extra.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Settings of a session, not of a cluster; see :func:`tune`.
TUNING = {
    # A generated method above 8000 bytes of bytecode is never compiled by the JVM. Wide
    # aggregations reach that size and then run several times slower than without whole-stage
    # code, so they should fall back to the operator-by-operator code, which is split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings wide aggregations need, leaving alone what the user has set."""
    chosen = dict(spark.sparkContext.getConf().getAll())
    for name, value in TUNING.items():
        if name not in chosen:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that the cluster names; in local mode, a scratch folder."""
    context = spark.sparkContext
    named = (
        spark.conf.get(CHECKPOINT_SETTING, None)
        or context.getConf().get(CHECKPOINT_SETTING)
        or context.getCheckpointDir()
    )
    if named is not None:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    application = context.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="creditloom-")
    return _LOCAL_FOLDERS[application]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it from there afterwards."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_root(spark: SparkSession) -> str:
    """The folder below the shared one that holds all intermediate tables of this application."""
    return f"{shared_folder(spark)}/scratch-{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name for intermediate tables of this application.

    What is written there is part of the plans of later results and stays until
    :func:`release_scratch`, or until the application's folder is removed from outside.
    """
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results built on them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the scratch folder and return that table.

    For intermediate tables of the size of an input that several passes read, each a few columns.
    ``most_rows`` is for narrow rows fresh from a ``distinct`` of which there are no more than that:
    they are stored by one task for each ``FILE_ROWS`` of it, not by every partition of the shuffle.
    """
    folder = scratch_folder(df.sparkSession) + "/table"
    if most_rows is not None:
        df = df.coalesce(max(1, math.ceil(most_rows / FILE_ROWS)))
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
