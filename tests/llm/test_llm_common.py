"""Where intermediate tables go."""

import os
import time
import types

import pytest

from storepulse.llm.common import free_name, shared_dir, staged


def session(master, setting=None, folder=None):
    context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: context.folder, folder=folder)
    context.setCheckpointDir = lambda path: setattr(context, "folder", f"{path}/id")
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, default=None: setting or default), sparkContext=context)


def test_the_setting_wins():
    assert shared_dir(session("yarn", "hdfs://x/shared/", "file:/y")) == "hdfs://x/shared"
    assert shared_dir(session("yarn", None, "hdfs://y")) == "hdfs://y"


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_without_the_setting_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(master))


def test_a_local_master_gets_its_own():
    spark = session("local[2]")
    assert shared_dir(spark) == shared_dir(spark) != shared_dir(session("local"))


def test_free_name():
    df = types.SimpleNamespace(columns=["_A", "_a_"])
    assert free_name(df, "_a") == "_a__"


def test_staged_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {
        name for top in manager.localDirs() for _, _, names in os.walk(top.getPath()) for name in names if name.startswith("shuffle_")
    }
    before, conf = held(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    out = staged(spark.range(2000).selectExpr("id % 100 AS k").groupBy("k").count(), "test")
    for _ in range(50):  # files go in the background
        if not held() - before:
            break
        time.sleep(0.2)
    assert not held() - before
    assert out.count() == 100 and out.agg({"count": "sum"}).first()[0] == 2000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == conf
