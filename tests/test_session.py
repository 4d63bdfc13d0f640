from __future__ import annotations

from types import SimpleNamespace

import pytest

from wattloom import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None, folder=None):
    conf = SimpleNamespace(get=lambda name, default=None: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_the_folder_named_by_the_cluster_is_used():
    spark = fake("spark://host:7077", configured="hdfs://shared/checkpoints")
    assert session.shared_dir(spark) == "hdfs://shared/checkpoints"
    assert spark.sparkContext.folder == "hdfs://shared/checkpoints"


def test_a_folder_set_on_the_context_is_used():
    spark = fake("yarn", folder="hdfs://shared/other")
    assert session.shared_dir(spark) == "hdfs://shared/other"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn"))


def test_only_a_local_master_gets_its_own_folder():
    spark = fake("local[4]")
    folder = session.shared_dir(spark)
    assert folder and session.shared_dir(spark) == folder
