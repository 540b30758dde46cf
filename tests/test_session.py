import pytest

from creditloom import session


class Conf(dict):
    def getAll(self):
        return list(self.items())


class Context:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint, self.conf = master, checkpoint, Conf()
        self.applicationId = "app-1"

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


class Session:
    """Stands in for a session on a cluster, which the tests cannot start."""

    def __init__(self, master, checkpoint=None, **conf):
        self.sparkContext = Context(master, checkpoint)
        self.conf = self
        self.settings = {name.replace("__", "."): value for name, value in conf.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def set(self, name, value):
        self.settings[name] = value


def test_the_folder_named_by_the_cluster_is_used():
    cluster = Session("yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert session.scratch_folder(cluster).startswith("hdfs:///shared/scratch-")
    assert session.scratch_folder(cluster) != session.scratch_folder(cluster)
    session.ensure_checkpoint_dir(cluster)
    assert cluster.sparkContext.checkpoint == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_folder(Session(master))
    assert session.shared_folder(Session("yarn", checkpoint="s3://x/y")) == "s3://x/y"


def test_tuning_leaves_user_settings_alone():
    chosen = Session("yarn")
    chosen.sparkContext.conf["spark.sql.codegen.hugeMethodLimit"] = "65535"
    assert session.tune(chosen).settings == {}
    assert session.tune(Session("yarn")).settings == session.TUNING


def test_written_and_cut_tables_keep_rows_and_types(spark):
    frame = spark.range(100).selectExpr("id", "id % 3 AS `a, b: (c)/d`", "uuid() AS u")
    for table in (session.written(frame), session.cut_lineage(frame)):
        assert table.dtypes == frame.dtypes
        assert table.collect() == table.collect()
        assert table.count() == 100


def test_scratch_tables_lie_together_and_can_be_released(spark):
    import os

    table = session.written(spark.range(3))
    root = session.scratch_root(spark).removeprefix("file:")
    assert table.inputFiles()[0].removeprefix("file://").startswith(root)
    assert session.scratch_folder(spark).startswith(session.scratch_root(spark))
    session.release_scratch(spark)
    assert not os.path.exists(root)
    assert session.written(spark.range(3)).count() == 3
