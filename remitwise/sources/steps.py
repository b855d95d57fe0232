"""Steps of a run that a later try takes up where a former one stopped.

A finished step is a published table (`versions`) below the folder of the run, named by the step and by
a key: a hash of the fingerprints of all inputs that the step depends on and of its settings. A rerun
over the same inputs finds the table and reads it; other inputs or settings give another key, so a step
is never taken up for the wrong data. A step that died has no published version and is done again.

Fingerprints are aggregations without an exchange of rows: they see every column of every row, do not
depend on order or partitioning, and tell a row received twice from one received once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from remitwise.sources.versions import publish, published


def sql_row_hash(columns: list[str]) -> str:
    """A hash of a row's columns.

    The hash function skips nulls: without the second part ('a', null) and (null, 'a') would be one row.
    """
    return f"xxhash64({', '.join([*columns, *[f'{c} is null' for c in columns]]) or '0'})"


def sql_checksum(row_hash: str) -> str:
    """An aggregate over rows that does not depend on their order.

    The exclusive or alone would not see two equal rows replaced by two others.
    """
    return (f"concat_ws('-', count(*), hex(coalesce(bit_xor({row_hash}), 0L)), "
            f"coalesce(sum(cast({row_hash} as decimal(20, 0))), 0))")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: `rows`, and `content`, a checksum of the rows that does not depend on their order.

    Columns are taken by place, so repeated or odd names do no harm; renaming one changes the
    fingerprint.
    """
    names = [f"_{i}" for i in range(len(df.columns))]
    shape = hashlib.sha256(df.schema.simpleString().encode()).hexdigest()[:16]
    return df.toDF(*names).selectExpr(f"{sql_row_hash(names)} as h").selectExpr(
        "count(*) as rows", f"concat('{shape}-', {sql_checksum('h')}) as content")


def fingerprints(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows, content): one row per table."""
    return reduce(DataFrame.unionByName, [
        fingerprint(df).selectExpr(f"'{name}' as table_name", "rows", "content")
        for name, df in tables.items()])


class Steps:
    """The steps of one run below `path`. One run at a time may use a folder.

    `inputs` are the contents of the run's inputs by name, `settings` whatever else the results
    depend on. `taken_up` and `written` name the steps of this try.
    """

    def __init__(self, spark: SparkSession, path: str, inputs: dict[str, str], settings: str = ""):
        self.spark, self.path, self.inputs, self.settings = spark, path, inputs, settings
        self.taken_up: list[str] = []
        self.written: list[str] = []

    def _folder(self, step: str, reads: tuple[str, ...] | None) -> str:
        held = self.inputs if reads is None else {r: self.inputs[r] for r in reads}
        text = "\n".join([step, *[f"{k}={v}" for k, v in sorted(held.items())],
                          *([self.settings] if reads is None else [])])
        return f"{self.path}/{step}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"

    def table(self, step: str, build: Callable[[], DataFrame],
              reads: tuple[str, ...] | None = None) -> DataFrame:
        """The table of a step: the finished one, or `build()` written now.

        `reads` names the inputs that the step depends on; None stands for all and the settings.
        Tables of the step with other keys are superseded: they go once the new one is published.
        """
        folder = self._folder(step, reads)
        version = published(self.spark, folder)
        if version:
            self.taken_up.append(step)
        else:
            version = publish(build(), folder)
            self.written.append(step)
            self._remove(step, folder)
        return self.spark.read.parquet(version)

    def finished(self, step: str) -> DataFrame | None:
        """The table of a step that depends on all inputs and the settings, if it is there."""
        version = published(self.spark, self._folder(step, None))
        return self.spark.read.parquet(version) if version else None

    def drop(self, step: str) -> None:
        """Remove the tables of a step whose last reader was written."""
        self._remove(step, None)

    def clear(self) -> None:
        """Remove every table of the run."""
        files, place = self._files()
        files.delete(place, True)

    def _files(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _remove(self, step: str, kept: str | None) -> None:
        files, place = self._files()
        if not files.exists(place):
            return
        for found in files.listStatus(place):
            name = found.getPath().getName()
            if name.rpartition("-")[0] == step and f"{self.path}/{name}" != kept:
                files.delete(found.getPath(), True)
