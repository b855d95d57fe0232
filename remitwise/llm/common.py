"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import remitwise
from remitwise.sources.scratch import scratch_path

# Text bytes that one step of a batch operator works on. A longer text is a step of its own.
STEP_BYTES = 2 << 20
# Rows of an Arrow batch, unless the session sets another number than Spark's default.
BATCH_ROWS = 1000


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns with exactly these names, whatever else the table holds.

    Names that differ from a wanted one only in case, or that need quoting, do no harm.
    """
    places = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.selectExpr(*[f"_{i} as `{n}`" for i, n in zip(places, names, strict=True)])


def land(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Applications whose executors have the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package as an archive, as `--py-files` does; Spark serves the file."""
    context = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        # The default of 10,000 whole texts per batch takes too much memory in both processes.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    folder = os.path.dirname(os.path.abspath(remitwise.__file__))
    with tempfile.TemporaryDirectory() as own:
        source = shutil.copytree(folder, f"{own}/code/remitwise",
                                 ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(f"{own}/remitwise", "zip", os.path.dirname(source))
        # Kept by the driver for executors that start later.
        kept = f"{tempfile.mkdtemp(prefix='remitwise-code-')}/remitwise.zip"
        shutil.copyfile(archive, kept)
    context.addPyFile(kept)
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """`mapInArrow` on executors that have this package.

    Python processes outlive a task, so each gives unused memory back before it waits for the next.
    """
    ship(df.sparkSession)

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return df.mapInArrow(lean, schema)


def release() -> None:
    """Return freed memory of this process to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `limit` bytes of `column`."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // limit)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the runs [start, start + length), one run after the other."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths) + np.arange(
        ends[-1] if len(ends) else 0)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, null as empty, and the offsets of its rows in them."""
    column = pc.fill_null(column, "")
    if column.offset or column.type != pa.string():
        column = pa.concat_arrays([column.cast(pa.string()).slice(0)])
    offsets = np.frombuffer(column.buffers()[1], np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(data: np.ndarray, offsets: np.ndarray) -> pa.DictionaryArray:
    """The distinct runs of bytes that `offsets` cut `data` into."""
    values = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    return values.dictionary_encode()


class PairTable:
    """Vectorised lookup of int32 values by 64-bit keys (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self._build(np.asarray(keys, np.uint64), np.asarray(values, np.int32))

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(8, int(8 * len(keys)).bit_length())
        self.shift, self.mask, self.count = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        self.add(keys, values)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Take up distinct keys that are not yet known."""
        if 2 * (self.count + len(keys)) > self.mask:
            used = self.values >= 0
            self._build(np.concatenate([self.keys[used], keys]),
                        np.concatenate([self.values[used], values]))
            return
        self.count += len(keys)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = todo[self.values[slot[todo]] < 0]
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for an unknown one."""
        shape, keys = keys.shape, keys.ravel()
        slot = self._slot(keys)
        out = self.values[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            out[todo] = self.values[slot[todo]]
            todo = todo[(out[todo] >= 0) & (self.keys[slot[todo]] != keys[todo])]
        return out.reshape(shape)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Regroup batches that are sorted by `key` (no nulls) so that none ends inside a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        last = pc.equal(keys, keys[batch.num_rows - 1]).index(True).as_py()
        if held and not held[-1].column(key)[held[-1].num_rows - 1].equals(keys[0]):
            yield pa.concat_batches(held)
            held = []
        if last:
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def group_cuts(column: pa.Array) -> np.ndarray:
    """Where the groups of a sorted column without nulls begin, and its length."""
    if not len(column):
        return np.zeros(1, np.int64)
    changed = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [len(column)]])
