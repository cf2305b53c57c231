"""The checkpoint folder: configured, missing, and cleared."""

from __future__ import annotations

import gc
import os
import time

import pytest

from commitlake.session import ensure_checkpoint_dir, scratch_path


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = _Context(master, folder)
        self.conf = {"spark.checkpoint.dir": setting}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_the_setting(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(master))


def test_the_setting_is_used_as_it_is():
    session = _Session("yarn", "hdfs://shared/checkpoints")
    assert ensure_checkpoint_dir(session) == "hdfs://shared/checkpoints"
    assert session.sparkContext.folder == "hdfs://shared/checkpoints"
    assert scratch_path(_Session("yarn", None, "hdfs://x/y/"), "t") == "hdfs://x/y/t"


def test_local_mode_gets_a_folder():
    session = _Session("local[2]")
    assert os.path.isdir(ensure_checkpoint_dir(session)) and session.sparkContext.folder


def test_checkpoint_files_go_with_their_frame(spark):
    if spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints", "false") != "true":
        pytest.skip("the session keeps its checkpoints")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    df = spark.range(10).checkpoint(eager=True)
    made = set(os.listdir(folder)) - before
    assert made and df.count() == 10
    del df
    for _ in range(50):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not made & set(os.listdir(folder)):
            break
        time.sleep(0.2)
    assert not made & set(os.listdir(folder))
