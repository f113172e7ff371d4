"""The shared work folder."""

from types import SimpleNamespace

import pytest

from eventide.session import run_dir, shared_dir


class Context:
    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None):
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_named_folder_is_used():
    assert shared_dir(session("spark://host:7077", "s3://bucket/work/")) == "s3://bucket/work"


def test_cluster_without_a_named_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_local_session_makes_its_own_folder_once():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_each_run_gets_a_new_folder(spark):
    assert run_dir(spark, "x") != run_dir(spark, "x")
