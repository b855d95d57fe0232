"""Feeds laid out once, so that audits over them need no exchange to bring a claim together.

Claims and remittance lines are typed and written in the same number of buckets of claim_id. Every audit
of these feeds then de-duplicates, rolls up and reconciles inside the buckets: the shuffle is paid when the
feeds are laid out, not by each run. A claim_id with more rows than one task may take would fill one bucket,
so such ids, and rows without an id, are written beside the buckets and aggregated as other feeds are, map
side first. An id is beside the buckets for both feeds or for none, so the two parts never share a claim.

A layout is replaced in one step, both feeds together; the one before it stays for its readers.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitwise.operators.layers import typed_claims, typed_remits
from remitwise.operators.skew import ROWS_PER_TASK
from remitwise.sources.versions import _files, publish, published

_FOLDER = "feeds-"


@dataclass(frozen=True)
class LaidOutFeeds:
    """Typed feeds in buckets of claim_id (`claims`, `remits`) and beside them (`loose_...`).

    `has_loose` is false if no claim is beside the buckets; lines without an id may still be.
    """

    claims: DataFrame
    remits: DataFrame
    loose_claims: DataFrame
    loose_remits: DataFrame
    has_loose: bool

    @property
    def lines(self) -> DataFrame:
        """Every remittance line, with a `line_no` of its own."""
        return self.remits.unionByName(self.loose_remits)


def _hot_ids(claims: DataFrame, remits: DataFrame, limit: int) -> DataFrame:
    """claim_ids with more than `limit` rows in both feeds together: at most rows / `limit` of them."""
    ids = claims.select("claim_id").unionByName(remits.select("claim_id"))
    return (ids.filter("claim_id is not null").groupBy("claim_id")
            .agg(F.expr("count(*) as held")).filter(f"held > {limit}").select("claim_id"))


def _bucketed(spark: SparkSession, folder: str, feed: str, buckets: int) -> DataFrame:
    """The bucketed table of a folder, made known to this session's catalog."""
    name = f"laid_out_{feed}_{folder.rpartition(_FOLDER)[2]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in spark.read.parquet(f"{folder}/{feed}").schema)
        place = f"{folder}/{feed}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"create table {name} ({columns}) using parquet clustered by (claim_id) "
                  f"sorted by (claim_id) into {buckets} buckets location '{place}'")
    return spark.table(name)


def lay_out(claims: DataFrame, remits: DataFrame, path: str, buckets: int | None = None,
            rows_per_task: int | None = None) -> LaidOutFeeds:
    """Type two landed feeds and write them to `path`, replacing the layout that is there.

    `buckets` is the number of tasks of an audit's grain, by default that of a shuffle; choose it so that
    rows / `buckets` fit a task. One count of ids finds those that are too large for a bucket.
    """
    spark = claims.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{path}/{_FOLDER}{uuid.uuid4().hex}"
    feeds = {"claims": typed_claims(claims), "remits": typed_remits(remits)}
    hot = _hot_ids(*feeds.values(), rows_per_task or ROWS_PER_TASK)
    hot.write.parquet(f"{folder}/hot_ids")
    hot = spark.read.schema("claim_id string").parquet(f"{folder}/hot_ids")
    for feed, rows in feeds.items():
        # Numbers of lines in buckets and beside them differ by their sign.
        number, beside = "monotonically_increasing_id()", "-1L - monotonically_increasing_id()"
        cold = rows.filter("claim_id is not null").join(F.broadcast(hot), "claim_id", "left_anti")
        loose = rows.filter("claim_id is null").unionByName(
            rows.join(F.broadcast(hot), "claim_id", "left_semi"))
        if feed == "remits":
            cold, loose = cold.selectExpr("*", f"{number} as line_no"), loose.selectExpr(
                "*", f"{beside} as line_no")
        # Hashed as buckets are: one file per bucket.
        (cold.select(*loose.columns).repartition(buckets, "claim_id")
         .write.bucketBy(buckets, "claim_id").sortBy("claim_id").format("parquet")
         .option("path", f"{folder}/{feed}")
         .saveAsTable(f"laid_out_{feed}_{folder.rpartition(_FOLDER)[2]}"))
        loose.write.parquet(f"{folder}/loose_{feed}")
    before = published(spark, f"{path}/layout")
    kept = {folder}
    if before:
        kept.add(spark.read.parquet(before).first().folder)
    claim_beside = not spark.read.parquet(f"{folder}/loose_claims").isEmpty()
    line_beside = not spark.read.parquet(f"{folder}/loose_remits").filter(
        "claim_id is not null").isEmpty()
    publish(spark.createDataFrame([(folder, buckets, claim_beside or line_beside)],
                                  "folder string, buckets int, has_loose boolean").coalesce(1),
            f"{path}/layout")
    files, place = _files(spark, path)
    for found in files.listStatus(place):
        name = found.getPath().getName()
        if name.startswith(_FOLDER) and f"{path}/{name}" not in kept:
            files.delete(found.getPath(), True)
    return open_layout(spark, path)


def open_layout(spark: SparkSession, path: str) -> LaidOutFeeds:
    """The feeds as last laid out in full at `path`, in this or another session."""
    version = published(spark, f"{path}/layout")
    if version is None:
        raise ValueError(f"no feeds are laid out at {path}")
    held = spark.read.parquet(version).first()  # one row
    claims, remits = (_bucketed(spark, held.folder, feed, held.buckets)
                      for feed in ("claims", "remits"))
    return LaidOutFeeds(
        claims, remits, spark.read.schema(claims.schema).parquet(f"{held.folder}/loose_claims"),
        spark.read.schema(remits.schema).parquet(f"{held.folder}/loose_remits"), held.has_loose)
