"""The exception register: the table that the correction queues work from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitwise.schemas import EXCEPTION_COLUMNS, QUEUE
from remitwise.sources.versions import parts, publish, published

REGISTER = T.StructType([
    T.StructField("exception_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
    *[T.StructField(c, {"date_of_service": T.DateType(), "billed_amount": T.DecimalType(18, 2),
                        "amount_impact": T.DecimalType(38, 2)}.get(c, T.StringType()))
      for c in EXCEPTION_COLUMNS],
    T.StructField("assigned_queue", T.StringType()), T.StructField("disposition", T.StringType()),
    T.StructField("disposition_reason", T.StringType()),
    T.StructField("resolved_ts", T.TimestampType()),
])
REGISTER_COLUMNS = REGISTER.fieldNames()


def sql_assigned_queue(check_id: str = "check_id") -> str:
    """The queue that owns a check."""
    pairs = ", ".join(f"'{check}', '{queue}'" for check, queue in QUEUE.items())
    return f"try_element_at(map({pairs}), {check_id})"


# Copies of one record that a task numbers in one go.
COPIES_PER_BLOCK = 1_000_000


def _numbered(exceptions: DataFrame, per_block: int) -> DataFrame:
    """Each exception with `copy`: 1, or the number of the copy where records are equal.

    Equal records are counted, map side first, and written out again from the count, in blocks of
    `per_block` copies, so that no row holds a list longer than that. The rows of one line posted
    again and again leave their task as a stream, and `write_run` deals them out.
    """
    counted = exceptions.groupBy(*EXCEPTION_COLUMNS).agg(F.expr("count(*) as copies"))
    return counted.selectExpr(
        "*", f"explode(sequence(0L, (copies - 1) div {per_block})) as block").selectExpr(
        *EXCEPTION_COLUMNS, f"explode(sequence(block * {per_block} + 1, "
                            f"least((block + 1) * {per_block}, copies))) as copy")


def exception_register(exceptions: DataFrame, run_id: str, run_ts: dt.datetime,
                       per_block: int = COPIES_PER_BLOCK, single: DataFrame | None = None) -> DataFrame:
    """Exceptions of a run with queue and open disposition.

    The id is a hash of the run, the whole record and the number of its copy, so a rerun gives the
    same ids and no two items share one. `single` holds more exceptions, no two of which are equal:
    they are not grouped.
    """
    record = ", ".join(f"coalesce(cast({c} as string), '<null>')" for c in EXCEPTION_COLUMNS)
    key = f"concat_ws(char(31), run_id, {record}, cast(copy as string))"
    numbered = _numbered(exceptions, per_block)
    if single is not None:
        numbered = single.selectExpr(*EXCEPTION_COLUMNS, "1L as copy").unionByName(numbered)
    run = numbered.select(
        F.lit(run_id).alias("run_id"), F.expr(f"timestamp'{run_ts.isoformat(' ')}' as run_ts"),
        *EXCEPTION_COLUMNS, "copy")
    return run.selectExpr(
        f"sha2({key}, 256) as exception_id", "run_id", "run_ts", *EXCEPTION_COLUMNS,
        f"{sql_assigned_queue()} as assigned_queue",
        "'OPEN' as disposition", "cast(null as string) as disposition_reason",
        "cast(null as timestamp) as resolved_ts")


def write_register(register: DataFrame, path: str) -> None:
    """Replace the runs contained in `register`, each in one step, keep the other runs in the table."""
    for run in register.select("run_id").distinct().collect():  # one row per run
        write_run(register, path, run.run_id)


def run_folder(run_id: str) -> str:
    """The partition folder of a run, named as Spark names and reads partitions."""
    if not run_id:
        raise ValueError("a run needs an id")
    # Characters that Spark writes as %XX in the folder of a partition.
    escaped = "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or c < " " else c
                      for c in run_id)
    return f"run_id={escaped}"


def write_run(register: DataFrame, path: str, run_id: str) -> str:
    """Replace one run in one step, also when it has no exceptions; returns the folder of its version.
    A write that fails leaves the run as it was, and nobody reads half of one.

    Exceptions are a small share of the rows of every split; `rebalance` gathers them into files of
    a good size.
    """
    return publish(register.filter(F.col("run_id") == run_id).drop("run_id").hint("rebalance"),
                   f"{path}/{run_folder(run_id)}")


def read_register(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The register, or one run of it; a run is one partition folder."""
    if run_id is None:
        folders = parts(spark, path)
    else:
        folders = [v for v in [published(spark, f"{path}/{run_folder(run_id)}")] if v]
    if not folders:
        return spark.createDataFrame([], REGISTER).select(*REGISTER_COLUMNS)
    register = (spark.read.schema(REGISTER).option("basePath", path).parquet(*folders)
                .select(*REGISTER_COLUMNS))
    return register if run_id is None else register.filter(F.col("run_id") == run_id)
