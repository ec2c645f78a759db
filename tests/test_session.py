"""Checkpoint-root rules: the session's setting first; a private folder
only on a local master; an error on a cluster without the setting."""

import pytest

from starload.session import checkpoint_root, local_path, staging_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckdir=None):
        self.master, self.ckdir = master, ckdir

    def getCheckpointDir(self):
        return self.ckdir

    def setCheckpointDir(self, d):
        self.ckdir = f"file:{d}/app-uuid"


class _Session:
    def __init__(self, master, conf=None, ckdir=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, ckdir)


def test_session_setting_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ck"})
    assert checkpoint_root(s) == "hdfs://nn/ck"
    assert s.sparkContext.getCheckpointDir() == "file:hdfs://nn/ck/app-uuid"


def test_existing_context_dir_is_reused():
    s = _Session("yarn", ckdir="hdfs://nn/ck/app-1234")
    assert checkpoint_root(s) == "hdfs://nn/ck"


def test_cluster_without_setting_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_local_without_setting_gets_private_folder():
    s = _Session("local[4]")
    root = checkpoint_root(s)
    assert "starload-ck-" in root
    # registered on the context: the next call finds the same folder
    assert local_path(checkpoint_root(s)) == root


def test_staging_paths_are_unique(spark):
    a, b = staging_path(spark, "t"), staging_path(spark, "t")
    assert a != b and a.endswith("/t") and a.startswith(checkpoint_root(spark))
