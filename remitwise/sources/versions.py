"""Tables that are replaced in one step.

A version is written beside the ones before it; then one small pointer file is replaced by a rename,
which is what publishes it. Readers follow the pointer, so a write that dies leaves the table as it was,
and nobody sees half of one. The version before the published one is kept for those who still read it,
older ones and remains of writes that died are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_published"
# Named as a partition folder, so that a table of many parts can be read in one go.
_VERSION = "version="


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version, or None if there is none yet."""
    files, place = _files(spark, f"{path}/{POINTER}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name.split()[0]}"


def publish(df: DataFrame, path: str) -> str:
    """Write `df` as the new version of the table at `path`; returns the version's folder."""
    spark = df.sparkSession
    before = published(spark, path)
    name = f"{_VERSION}{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    _point(spark, path, name)
    _clear(spark, path, {name, before and before.rsplit("/", 1)[1]})
    return f"{path}/{name}"


def _point(spark: SparkSession, path: str, name: str) -> None:
    files, own = _files(spark, f"{path}/_{uuid.uuid4().hex}")
    stream = files.create(own)
    stream.writeBytes(name + "\n")
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    replace = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    replace[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(own, hadoop.Path(f"{path}/{POINTER}"), replace)


def _clear(spark: SparkSession, path: str, kept: set[str | None]) -> None:
    files, place = _files(spark, path)
    for found in files.listStatus(place):
        name = found.getPath().getName()
        if name.startswith(_VERSION) and name not in kept:
            files.delete(found.getPath(), True)


def parts(spark: SparkSession, path: str) -> list[str]:
    """The published versions of all tables that are folders of `path`."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return []
    names = sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())
    return [v for v in (published(spark, f"{path}/{name}") for name in names) if v]
