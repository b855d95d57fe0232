"""Folders for tables that cut lineage between the steps of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Temporary folders of local applications that configure none.
_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; a local temporary one on a local master only."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="remitwise-")
    return _LOCAL[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
