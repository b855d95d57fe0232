"""CSV exports of a run, and reading them back.

Each large export carries a manifest of its files: place in the order, first and last key, rows, total
amount and a checksum that does not depend on order, taken from the files by a second aggregation.
Reading back holds the files against it, so a lost, repeated or changed file is not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitwise import schemas
from remitwise.schemas import TOTAL, check_routing
from remitwise.sources.steps import sql_checksum, sql_row_hash


# Text is written on one line, so that files stay splittable: these characters become a backslash
# and a letter. A field without text reads as a lone marker, which escaped text cannot be.
_ESCAPES = {"\\": "\\s", "\n": "\\n", "\r": "\\r"}
_NOTHING = "\\N"


def _replaced(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """`df` with pieces of its text columns replaced, one pair after the other."""
    def column(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            for old, new in pairs:
                value = F.replace(value, F.lit(old), F.lit(new))
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    # The backslash comes first: the others add backslashes.
    (_replaced(df, list(_ESCAPES.items())).write.mode("overwrite").option("header", True)
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).partitionBy(*partitions).csv(path))


def _read(spark: SparkSession, path: str, schema: T.StructType, file: bool = False) -> DataFrame:
    """The rows below `path`; with `file`, also the path of each row's file."""
    rows = (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("nullValue", _NOTHING).option("emptyValue", "").option("columnPruning", False)
            .option("mode", "FAILFAST").csv(path))
    if file:
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    return _replaced(rows, [(new, old) for old, new in reversed(_ESCAPES.items())])


@dataclass(frozen=True)
class Delivery:
    """An export with a manifest: its columns, those that order it (NULL last), the amount totalled."""

    schema: T.StructType
    order: list[str]
    amount: str


class DeliveryBroken(ValueError):
    """The files of an export are not those of its manifest."""


_TYPES = {f.name: f for f in schemas.REGISTER_EXPORT.fields}
DELIVERIES = {
    "exception_register": Delivery(
        T.StructType([*schemas.REGISTER_EXPORT.fields,
                      T.StructField("absolute_impact", T.DecimalType(38, 2))]),
        ["check_id", "entity_key"], "absolute_impact"),
    "exceptions": Delivery(
        T.StructType([*[_TYPES[c] for c in schemas.EXCEPTION_COLUMNS],
                      T.StructField("evidence", T.StringType())]),
        ["evidence", "entity_key"], "amount_impact"),
    "claim_reconciliation": Delivery(schemas.RECON_EXPORT, ["claim_id"], "billed_amount"),
}


def _manifest_of_files(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One row per file with rows; `part` is its place in the order of its folder."""
    held = DELIVERIES[name]
    key = "struct(" + ", ".join(f"{c} is null as no_{c}, {c}" for c in held.order) + ")"
    rows = _read(spark, f"{out}/{name}", held.schema, file=True)
    return rows.selectExpr(
        f"substring_index(_file, '/{name}/', -1) as file", f"{key} as key",
        f"{held.amount} as amount", f"{sql_row_hash(held.schema.names)} as h").groupBy("file").agg(
        F.expr("count(*) as rows"), F.expr("min(key) as first_key"), F.expr("max(key) as last_key"),
        F.expr(f"cast(coalesce(sum(amount), 0) as {TOTAL}) as amount"),
        F.expr(f"{sql_checksum('h')} as content")).selectExpr(
        f"'{name}' as export",
        "if(contains(file, '/'), substring_index(file, '/', 1), '') as folder",
        "cast(regexp_extract(file, 'part-([0-9]+)', 1) as bigint) as part", "*")


def _deliver(spark: SparkSession, out: str, name: str) -> None:
    _manifest_of_files(spark, out, name).write.mode("overwrite").parquet(f"{out}/manifest/{name}")


def manifest(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The manifest of an export: one row per file."""
    return spark.read.parquet(f"{out}/manifest/{name}")


def delivery_order(spark: SparkSession, out: str) -> DataFrame:
    """Per export and folder: rows, first and last key, total amount, and how many files start before
    the one in front of them ends, which an ordered export has none of.

    Works on the manifests: one row per file.
    """
    def listed(name: str) -> DataFrame:
        def text(key: str) -> str:
            return f"concat_ws('|', {', '.join(f'{key}.{c}' for c in DELIVERIES[name].order)})"

        files = manifest(spark, out, name).selectExpr(
            "*", "lag(last_key) over (partition by folder order by part, file) > first_key as early")
        return files.groupBy("export", "folder").agg(
            F.expr("sum(rows) as rows"), F.expr(f"{text('min(first_key)')} as first_key"),
            F.expr(f"{text('max(last_key)')} as last_key"),
            F.expr(f"cast(sum(amount) as {TOTAL}) as amount"),
            F.expr("count_if(early) as overlaps"))

    one, two, three = map(listed, DELIVERIES)
    return one.unionByName(two).unionByName(three)


def verify(spark: SparkSession, out: str, name: str) -> None:
    """Stop unless the files of an export are those of its manifest; at most five are named."""
    columns = ["rows", "first_key", "last_key", "amount", "content"]
    told, seen = (df.selectExpr("file", f"struct({', '.join(columns)}) as {side}") for df, side in (
        (manifest(spark, out, name), "told"), (_manifest_of_files(spark, out, name), "seen")))
    broken = (told.join(seen, "file", "full").filter("not (told <=> seen)").selectExpr(
        "file", "case when seen is null then 'missing' when told is null then 'not of this delivery' "
                "else 'changed' end as state").orderBy("file").limit(5).collect())
    if broken:
        raise DeliveryBroken(f"{name}: " + ", ".join(f"{r.file} is {r.state}" for r in broken))


def export_reports(reports: dict[str, DataFrame], out: str) -> None:
    """One folder per report, in the order of the report over its files."""
    for name, df in reports.items():
        _write(df, f"{out}/{name}")


def export_register(register: DataFrame, out: str) -> None:
    """The register without its internal columns, by check and entity."""
    rows = register.select(*schemas.REGISTER_EXPORT_COLUMNS,
                           F.abs("amount_impact").alias("absolute_impact"))
    _write(rows.orderBy(F.col("check_id").asc_nulls_last(), F.col("entity_key").asc_nulls_last()),
           f"{out}/exception_register")
    _deliver(register.sparkSession, out, "exception_register")


def export_exceptions(register: DataFrame, out: str) -> None:
    """One folder per check, `evidence=<name>`, in key order over its files; a clean check's holds a
    file with the header alone.

    Rows are split by ranges of (check_id, entity_key, exception_id), so neither a check with many
    findings nor a key with many becomes one large task.
    """
    spark = register.sparkSession
    names = check_routing(spark).select("check_id", "evidence")
    rows = (register.repartitionByRange("check_id", "entity_key", "exception_id")
            .join(F.broadcast(names), "check_id", "left")  # twelve rows
            .sortWithinPartitions("evidence", "entity_key", "exception_id")
            .select(*schemas.EXCEPTION_COLUMNS, "evidence"))
    _write(rows, f"{out}/exceptions", "evidence")
    # At most one row per check.
    found = {row[0] for row in register.select("check_id").distinct().collect()}
    nothing = register.limit(0).select(*schemas.EXCEPTION_COLUMNS)
    for row in schemas.ROUTING:
        if row[0] not in found:
            _write(nothing, f"{out}/exceptions/evidence={row[5]}")
    _deliver(spark, out, "exceptions")


def export_recon(recon: DataFrame, out: str) -> None:
    """The reconciliation grain by claim."""
    _write(recon.select(*schemas.RECON_EXPORT_COLUMNS).orderBy(F.col("claim_id").asc_nulls_last()),
           f"{out}/claim_reconciliation")
    _deliver(recon.sparkSession, out, "claim_reconciliation")


def read_delivery(spark: SparkSession, out: str, name: str) -> DataFrame:
    """An export as it was written: its files are held against the manifest first."""
    verify(spark, out, name)
    return _read(spark, f"{out}/{name}", DELIVERIES[name].schema)


def read_report(spark: SparkSession, out: str, name: str, schema: T.StructType) -> DataFrame:
    """A report as exported, with the columns that it had."""
    return _read(spark, f"{out}/{name}", schema)


def read_exports(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The register and the reconciliation as exported, for independent recomputation."""
    return {name: read_delivery(spark, out, name)
            for name in ("exception_register", "claim_reconciliation")}


def read_exceptions(spark: SparkSession, out: str) -> DataFrame:
    """The per-check files."""
    return read_delivery(spark, out, "exceptions").select(*schemas.EXCEPTION_COLUMNS)
