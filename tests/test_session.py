"""Checkpoint folder rules: the shared folder named by spark.checkpoint.dir, a
scratch folder only for a local master, never a machine-local one on a cluster."""

import pytest

from churnlab.session import cluster_conf, ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, conf=None):
        self.master = master
        self._dir = None
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, session_conf=None, context_conf=None):
        self.sparkContext = _Context(master, context_conf)
        self.conf = _Conf(session_conf or {})


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_named_shared_folder():
    s = _Session("yarn", session_conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_master_gets_a_scratch_folder():
    s = _Session("local[4]")
    path = ensure_checkpoint_dir(s)
    assert path and s.conf.get("spark.checkpoint.dir") == path


def test_existing_context_folder_wins():
    s = _Session("yarn")
    s.sparkContext.setCheckpointDir("s3://bucket/ckpt")
    assert ensure_checkpoint_dir(s) == "s3://bucket/ckpt"


def test_cluster_conf_keeps_aqe_on():
    conf = cluster_conf(10 * 1024**4, 2000)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
