import time
from types import SimpleNamespace

import pytest

from conftest import rows
from matchstrata import session


def fake(master, setting=None):
    conf = {session.CHECKPOINT_CONF: setting} if setting else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get, set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert session.scratch_root(fake("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert session.scratch_path(spark, "x").startswith(spark.conf.get(session.CHECKPOINT_CONF))


def test_a_cluster_without_the_setting_is_an_error_and_local_mode_makes_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("yarn"))
    local = fake("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_staged_frames_can_be_read_again_until_discarded(spark):
    staged = session.stage(spark.range(5), "five")
    assert rows(staged.df) == rows(staged.df) == [(i,) for i in range(5)]
    staged.discard()
    with pytest.raises(Exception):
        staged.df.count()


def test_a_stored_frame_leaves_no_shuffle_behind(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: disk.getAllFiles().mkString("\n").count("/shuffle_")
    before = shuffled()
    staged = session.stage(spark.range(1000).repartition(7, "id"), "shuffled")
    for _ in range(50):  # the files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert staged.df.count() == 1000
    assert spark.conf.get(session.SHUFFLE_CLEANUP_CONF, "false") == "false"
