"""Checkpoint folder rules: use the session's setting; make one only for a local session."""

import pytest

import os

from dialstat import session
from dialstat.session import delete_path, ensure_checkpoint_dir, release_scratch, shared_scratch_path


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.applicationId = "app-1"

    def getCheckpointDir(self):  # noqa: N802 - mirrors SparkContext
        return self.current

    def setCheckpointDir(self, path):  # noqa: N802
        self.current = f"file:{path}/uuid"


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_existing_checkpoint_dir_is_used():
    s = _Session("yarn", current="hdfs://shared/ckpt/abc")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt/abc"


def test_configured_checkpoint_dir_is_applied():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs://shared/checkpoints"})
    assert ensure_checkpoint_dir(s).startswith("file:hdfs://shared/checkpoints")


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_single_machine_session_gets_a_folder_beside_its_warehouse(monkeypatch):
    marked = []
    monkeypatch.setattr(session, "_delete_on_exit", lambda spark, path: marked.append(path))
    s = _Session("local[2]", conf={"spark.sql.warehouse.dir": "file:/data/warehouse"})
    assert "/data/warehouse-scratch/app-1" in ensure_checkpoint_dir(s)
    assert marked == ["file:/data/warehouse-scratch/app-1"]


def test_local_cluster_is_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))


def test_scratch_is_deleted(spark):
    path, other = shared_scratch_path(spark, "x"), shared_scratch_path(spark, "y")
    for p in (path, other):
        spark.range(3).write.parquet(p)
    delete_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:")) and os.path.exists(other.removeprefix("file:"))
    assert release_scratch(spark) >= 2
    assert not os.path.exists(other.removeprefix("file:"))


def test_scratch_paths_are_unique_and_below_the_checkpoint_dir(spark):
    a, b = shared_scratch_path(spark, "x"), shared_scratch_path(spark, "x")
    base = spark.sparkContext.getCheckpointDir()
    assert a != b and a.startswith(base) and b.startswith(base)
