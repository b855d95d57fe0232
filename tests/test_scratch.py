"""Where written tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from remitwise.sources.scratch import scratch_path, scratch_root


def session(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}-{conf}",
                              getConf=lambda: {"spark.checkpoint.dir": conf} if conf else {},
                              getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(sparkContext=context)


def test_configured_folder_comes_first(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and scratch_root(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_root(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert scratch_root(session("yarn", None, "hdfs://set/later")) == "hdfs://set/later"


def test_temporary_folder_is_local_only():
    local = session("local[2]")
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://host:7077"))
