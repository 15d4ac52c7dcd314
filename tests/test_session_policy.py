import pytest

from tabsieve.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _SC:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, master, conf=()):
        self.sparkContext = _SC(master, dict(conf))
        self.conf = _Conf(dict(conf))


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_gets_a_scratch_folder_only_when_unset(tmp_path):
    s = _Spark("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d
    s2 = _Spark("local[2]", {"spark.checkpoint.dir": str(tmp_path)})
    assert ensure_checkpoint_dir(s2) == str(tmp_path)
