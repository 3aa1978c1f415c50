from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemark.session import SETTINGS, configure, shared_dir


def stub(master, setting=None, checkpoint_dir=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting or default), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(stub("spark://host:7077", "s3a://bucket/ck/"), "lake").startswith("s3a://bucket/ck/lake-")
    assert shared_dir(stub("yarn", None, "hdfs:/ck"), "lake").startswith("hdfs:/ck/lake-")
    assert shared_dir(stub("yarn", "x"), "a") != shared_dir(stub("yarn", "x"), "a")


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(stub("spark://host:7077"), "lake")


def test_settings_are_applied(spark):
    configure(spark)
    assert {name: spark.conf.get(name) for name in SETTINGS} == SETTINGS
