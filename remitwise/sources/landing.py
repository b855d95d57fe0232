"""Landing reads: both feeds as text, master data with types."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitwise import schemas
from remitwise.sources.versions import publish, published

# What a field without text reads as before it becomes NULL, so that a quoted `""` stays `''`.
_NOTHING = "\u0001nothing\u0001"

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Feed:
    """A CSV file split in two: rows with the right number of fields, and the lines of the others."""

    landed: DataFrame
    rejected: DataFrame


def _csv(spark: SparkSession, path: str, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Every column as text, and the whole line in `CORRUPT` where the number of fields is wrong.

    Column pruning is off, since a pruned read does not look at the fields it leaves out.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    rows = (spark.read.schema(schema).option("multiLine", multi_line)
            .option("header", True).option("escape", '"').option("nullValue", _NOTHING)
            .option("emptyValue", "").option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    # Spark refuses a read of the corrupt line alone; no field ever equals the marker.
    line = f"coalesce({CORRUPT}, if({columns[0]} = '{_NOTHING}', '', null)) as {CORRUPT}"
    return rows.selectExpr(*columns, line)


def _split(spark: SparkSession, path: str, columns: list[str], multi_line: bool) -> Feed:
    rows = _csv(spark, path, columns, multi_line)
    rejected = rows.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"), F.lit(f"not {len(columns)} fields").alias("reason"))
    return Feed(rows.filter(F.col(CORRUPT).isNull()).select(*columns), rejected)


def _whole(path: str, rows: DataFrame, broken: str) -> DataFrame:
    """`rows`, with a filter that stops the job at a broken one whatever columns are read."""
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *rows.columns))
    stop = F.raise_error(F.concat(F.lit(f"malformed row in {path}: "), line))
    return rows.filter(F.when(F.expr(broken), stop.cast("boolean")).otherwise(F.lit(True)))


def split_claims(spark: SparkSession, path: str, multi_line: bool = False) -> Feed:
    """Claims extract with its malformed lines set aside, for a receipt that counts them."""
    return _split(spark, path, schemas.CLAIM_COLUMNS, multi_line)


def split_remits(spark: SparkSession, path: str, multi_line: bool = False) -> Feed:
    """Remittance extract with its malformed lines set aside."""
    return _split(spark, path, schemas.REMIT_COLUMNS, multi_line)


def read_claims(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Claims extract, every column as text so that bad values land.

    A row with too few or too many fields stops the load; `split_claims` sets it aside instead. An
    empty field is NULL, a quoted empty one `''`. `multi_line` allows line breaks inside quotes, which
    are malformed rows without it; such a file is read whole by one task, so keep it off for
    large files.
    """
    rows = _csv(spark, path, schemas.CLAIM_COLUMNS, multi_line)
    return _whole(path, rows, f"{CORRUPT} is not null").select(*schemas.CLAIM_COLUMNS)


def read_remits(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Remittance extract, read as `read_claims` reads."""
    rows = _csv(spark, path, schemas.REMIT_COLUMNS, multi_line)
    return _whole(path, rows, f"{CORRUPT} is not null").select(*schemas.REMIT_COLUMNS)


def _master(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed table whose every column is required."""
    values = {f.name: f"try_cast({f.name} as {f.dataType.simpleString()})" for f in schema}
    broken = " or ".join([f"{CORRUPT} is not null", *[f"{v} is null" for v in values.values()]])
    return (_whole(path, _csv(spark, path, schema.names), broken)
            .selectExpr(*[f"{value} as {name}" for name, value in values.items()]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Planted defects, used for scoring only; a malformed row stops the load."""
    rows = _csv(spark, path, schemas.LEDGER.names)
    return _whole(path, rows, f"{CORRUPT} is not null").select(*schemas.LEDGER.names)


def read_payers(spark: SparkSession, path: str) -> DataFrame:
    """Payer master; a malformed row or a missing value stops the load."""
    return _master(spark, path, schemas.PAYERS)


def read_cpt(spark: SparkSession, path: str) -> DataFrame:
    """CPT charge master; a malformed row or a missing value stops the load."""
    return _master(spark, path, schemas.CPT)


def land(df: DataFrame, path: str) -> DataFrame:
    """Replace the landing table at `path` in one step and read it back.

    A load that fails leaves the rows of the former one (`landed`).
    """
    return df.sparkSession.read.schema(df.schema).parquet(publish(df, path))


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The landing table as last loaded in full."""
    version = published(spark, path)
    if version is None:
        raise ValueError(f"nothing has landed at {path}")
    return spark.read.parquet(version)


def load_receipt(tables: dict[str, DataFrame],
                 rejected: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows loaded per table, and how many lines of its file were set aside."""
    def counted(frames: dict[str, DataFrame], name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)
            for table, df in frames.items()])

    receipt = counted(tables, "rows_loaded")
    if not rejected:
        return receipt.withColumn("rows_rejected", F.lit(0).cast("long"))
    # One row per table on both sides.
    return receipt.join(F.broadcast(counted(rejected, "rows_rejected")), "table_name", "left") \
        .selectExpr("table_name", "rows_loaded", "coalesce(rows_rejected, 0L) as rows_rejected")


def reference_violations(table: str, df: DataFrame, key: list[str],
                         required: list[str] | None = None,
                         parent: DataFrame | None = None) -> DataFrame:
    """Broken table rules: repeated or NULL keys, NULL in required columns, missing parents.

    `parent` holds the allowed values of the columns it shares with `df`. One aggregation by key
    counts for all rules but the last, which needs one by the shared columns.
    """
    def shown(columns: list[str]) -> str:
        return "concat_ws('|', " + ", ".join(
            f"coalesce(cast({c} as string), '<null>')" for c in columns) + ") as key_value"

    named = f"'{table}' as table_name"
    columns = [*key, *(required or [])]
    counted = df.groupBy(*key).agg(F.expr("count(*) as held"), *[
        F.expr(f"count_if({c} is null) as missing_{i}") for i, c in enumerate(columns)])
    rules = [f"struct('UNIQUE' as rule, '{','.join(key)}' as column_name, "
             "if(held > 1, held, 0L) as rows)"]
    rules += [f"struct('NOT NULL' as rule, '{c}' as column_name, missing_{i} as rows)"
              for i, c in enumerate(columns)]
    found = (counted.selectExpr(named, shown(key), f"inline(array({', '.join(rules)}))")
             .filter("rows > 0").select("table_name", "rule", "column_name", "key_value", "rows"))
    if parent is not None:
        shared = [c for c in parent.columns if c in df.columns]
        values = df.na.drop(subset=shared).groupBy(*shared).agg(F.expr("count(*) as rows"))
        absent = values.join(parent.select(*shared).distinct(), shared, "left_anti")
        found = found.unionByName(absent.selectExpr(
            named, "'FOREIGN KEY' as rule", f"'{','.join(shared)}' as column_name", shown(shared),
            "rows"))
    return found


def require_key(name: str, df: DataFrame, key: str) -> None:
    """Stop if `key` of a master table is missing or repeated: each row joined to it would double."""
    broken = (df.groupBy(key).agg(F.expr("count(*) as rows")).filter(f"{key} is null or rows > 1")
              .orderBy(key).limit(5).collect())
    if broken:
        named = ", ".join(f"{row[0]!r} ({row[1]} rows)" for row in broken)
        raise ValueError(f"{name}: {key} must be there and unique, but is {named}")
