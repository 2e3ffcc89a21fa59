"""Checkpoint folder rules of ``vodlens.session`` (stand-in session objects)."""

import pytest

from vodlens.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _Context(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_setting_is_used_as_is():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_existing_checkpoint_dir_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///other"}, ckpt="hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_without_setting_gets_its_own_folder():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path
