"""The typed, de-duplicated and reconciled tables that the checks read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitwise.functions.scalars import (sql_blank_to_null, sql_money, sql_safe_date,
                                         sql_safe_numeric, sql_sorted_list, sql_zero)
from remitwise.operators.bloom import may_match, may_not_match, words_for
from remitwise.operators.skew import is_small, lookup, spread_join
from remitwise.schemas import (CLAIM_COLUMNS, CLAIM_RAW_COLUMNS, LIST_COLUMNS, RECON_COLUMNS,
                               REMIT_COLUMNS, TOTAL, TYPED_CLAIM_COLUMNS)
from remitwise.sources.scratch import scratch_path

_DATES = {"date_of_service", "claim_submit_date", "remit_date"}
_AMOUNTS = {"units", "billed_amount", "expected_allowed_amount", "allowed_amount", "paid_amount",
            "patient_responsibility", "contractual_adjustment"}


def _typed(name: str, key: str) -> str:
    if name == key:
        return f"trim({name}) as {name}"
    if name in _DATES:
        return f"{sql_safe_date(name)} as {name}"
    if name in _AMOUNTS:
        return f"{sql_safe_numeric(name)} as {name}"
    return f"{sql_blank_to_null(name)} as {name}"


def typed_claims(raw: DataFrame) -> DataFrame:
    """Every claim row with types; the text of four checked columns is kept beside them."""
    return raw.selectExpr(*[_typed(c, "claim_id") for c in CLAIM_COLUMNS],
                          *[f"{c} as {c}_raw" for c in CLAIM_RAW_COLUMNS])


def typed_remits(raw: DataFrame) -> DataFrame:
    """Every remittance line with types."""
    return raw.selectExpr(*[_typed(c, "remit_id") for c in REMIT_COLUMNS])


def claims_by_id(typed: DataFrame) -> DataFrame:
    """One row per claim_id: the row kept, how often the id was received and, if repeated, from where.

    The row kept is the first by batch and source (NULL last), then by every other column, so the
    choice does not depend on input order. One aggregation with a map-side combine does both, so
    a claim_id that fills a third of the feed reaches its task as one row per input split.
    """
    first = ["ingest_batch_id", "source_system"]
    rest = [c for c in TYPED_CLAIM_COLUMNS if c not in ("claim_id", *first)]
    rank = ", ".join([f"{c} is null as no_{c}, {c}" for c in first] + rest)
    grouped = typed.groupBy("claim_id").agg(
        F.expr(f"min(struct({rank})) as kept"),
        F.expr("count(*) as occurrences"),
        F.expr("max(billed_amount) as max_billed_amount"),
        F.expr("collect_set(source_system) as sources"),
        F.expr("collect_set(ingest_batch_id) as batches"))
    return grouped.selectExpr(
        "claim_id", *[f"kept.{c} as {c}" for c in TYPED_CLAIM_COLUMNS if c != "claim_id"],
        "occurrences", "max_billed_amount",
        f"if(occurrences > 1, {sql_sorted_list('sources', ', ')}, null) as source_systems",
        f"if(occurrences > 1, {sql_sorted_list('batches', ', ')}, null) as ingest_batches")


def claims_alone(typed: DataFrame) -> DataFrame:
    """`claims_by_id` of rows whose claim_id no other row has."""
    return typed.selectExpr(
        *TYPED_CLAIM_COLUMNS, "1L as occurrences", "billed_amount as max_billed_amount",
        "cast(null as string) as source_systems", "cast(null as string) as ingest_batches")


def claim_unique(typed: DataFrame) -> DataFrame:
    """One row per claim_id."""
    return claims_by_id(typed).select(*TYPED_CLAIM_COLUMNS)


def _rollup(remits: DataFrame, more: list[str]) -> DataFrame:
    measures = [
        "count(*) as remit_line_count",
        f"cast(sum(allowed_amount) as {TOTAL}) as allowed_total",
        f"cast(sum(paid_amount) as {TOTAL}) as paid_total",
        f"cast(sum(patient_responsibility) as {TOTAL}) as patient_resp_total",
        f"cast(sum(contractual_adjustment) as {TOTAL}) as adjustment_total",
        "min(remit_date) as first_remit_date",
        "max(remit_date) as last_remit_date",
        "min(claim_status_code) as remit_status_code",
        *more,
    ]
    return (remits.filter("claim_id is not null").groupBy("claim_id")
            .agg(*[F.expr(m) for m in measures]))


def remit_totals(remits: DataFrame) -> DataFrame:
    """The rollup without its lists: the state of a claim has a fixed size, however many lines.

    `first_check_eft_number` is the check of a claim with one line.
    """
    return _rollup(remits, ["min(check_eft_number) as first_check_eft_number"])


def totals_alone(remits: DataFrame) -> DataFrame:
    """`remit_totals` of lines whose claim_id no other line has; amounts are as narrow as in the line."""
    return remits.filter("claim_id is not null").selectExpr(
        "claim_id", "1L as remit_line_count", "allowed_amount as allowed_total",
        "paid_amount as paid_total", "patient_responsibility as patient_resp_total",
        "contractual_adjustment as adjustment_total",
        "remit_date as first_remit_date", "remit_date as last_remit_date",
        "claim_status_code as remit_status_code", "check_eft_number as first_check_eft_number")


def repeated_ids(*feeds: DataFrame, bucketed: bool = False) -> DataFrame:
    """Hashes of the claim_ids that one of the feeds has in several rows, normally few; written.

    Hashes are counted, in a state of fixed size. Feeds in buckets of claim_id are counted by the id
    itself, which needs no exchange.
    """
    key, kept = "xxhash64(claim_id) as id", "id as id_hash"
    if bucketed:
        key, kept = "claim_id", "xxhash64(claim_id) as id_hash"
    ids = [feed.selectExpr(key) for feed in feeds]
    seen = [i.groupBy(*i.columns).agg(F.expr("count(*) as times")).filter("times > 1")
            .selectExpr(kept) for i in ids]
    return store(reduce(DataFrame.unionByName, seen), scratch_path(feeds[0].sparkSession, "ids"))


def alone_and_repeated(rows: DataFrame, claim_id: str = "claim_id", seen: DataFrame | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """`rows` in two parts: those whose claim_id, an expression, no other row has, and the rest.

    `seen`, by default the `repeated_ids` of `rows`, fills a filter. All rows of an id lie in one part,
    in the same one for all tables that are cut by the same `seen`: whatever passes the filter is in the
    second, which may hold some rows that are alone too.
    """
    seen = seen or repeated_ids(rows.selectExpr(f"{claim_id} as claim_id"))
    words = words_for(seen.count())
    hashed = rows.selectExpr("*", f"xxhash64({claim_id}) as id_hash")
    alone, repeated = (part(hashed, seen, ["id_hash"], words).drop("id_hash")
                       for part in (may_not_match, may_match))
    return alone, repeated


def remit_by_claim(remits: DataFrame) -> DataFrame:
    """Remittance lines rolled up to the claim; lines without a claim_id are left out.

    The two lists hold every distinct code and check of a claim in one value.
    """
    return _rollup(remits, [
        f"{sql_sorted_list('collect_set(carc_code)', ',')} as carc_codes",
        f"{sql_sorted_list('collect_set(check_eft_number)', ',')} as check_eft_numbers"])


def _balance() -> dict[str, str]:
    """Rollup columns that the join completes."""
    accounted = " + ".join(sql_zero(c) for c in
                           ("paid_total", "patient_resp_total", "adjustment_total"))
    return {
        "remit_line_count": "coalesce(remit_line_count, 0L)",
        "remit_accounted_total": sql_money(accounted),
        "balance_variance": sql_money(f"billed_amount - ({accounted})"),
    }


def claim_recon(unique: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row per unique claim with its payments, amount accounted for and variance."""
    balance = _balance()
    return unique.join(rollup, "claim_id", "left").selectExpr(
        *[f"{balance.get(c, c)} as {c}" for c in RECON_COLUMNS])


def audit_grain(claims: DataFrame, totals: DataFrame) -> DataFrame:
    """Claims (`claims_by_id`) full outer joined to their totals (`remit_totals`).

    One join serves the reconciliation and the orphan check: `in_claims` is false for a claim_id
    that only the remittances know. Sides that leave an aggregation are hashed on claim_id, so the
    join adds no exchange to these.
    """
    wide = {c: f"cast({c} as {TOTAL})" for c in
            ("allowed_total", "paid_total", "patient_resp_total", "adjustment_total")}
    balance = {**wide, **_balance(), "in_claims": "coalesce(in_claims, false)",
               "payer_known": "coalesce(payer_known, false)"}
    joined = claims.withColumn("in_claims", F.lit(True)).join(totals, "claim_id", "full")
    added = [c for c in balance if c not in joined.columns and c != "payer_known"]
    return joined.selectExpr(*[f"{balance.get(c, c)} as {c}" for c in [*joined.columns, *added]])


@dataclass(frozen=True)
class Layer:
    """Materialised inputs of the checks.

    `grain`: `audit_grain` plus `payer_known`. `remits`: typed lines plus `line_no`, a number that
    tells equal lines apart. `flagged`: the lines of a claim_id that has several lines or is absent
    from the claims, with the claim's columns; lines without a claim_id are flagged too.
    """

    grain: DataFrame
    remits: DataFrame
    flagged: DataFrame
    payers: DataFrame
    path: str
    rows_per_task: int | None = None

    @property
    def claims(self) -> DataFrame:
        return self.grain.filter("in_claims")

    @property
    def claim_unique(self) -> DataFrame:
        return self.claims.select(*TYPED_CLAIM_COLUMNS)

    @property
    def recon(self) -> DataFrame:
        """The reconciliation without its lists."""
        return self.claims.select(*[c for c in RECON_COLUMNS if c not in LIST_COLUMNS])

    @property
    def remit_by_claim(self) -> DataFrame:
        return remit_by_claim(self.remits)

    @property
    def claim_recon(self) -> DataFrame:
        return claim_recon(self.claim_unique, self.remit_by_claim)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: the cut in the lineage of everything after it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flagged_lines(remits: DataFrame, grain: DataFrame, payers: DataFrame, payers_small: bool,
                  rows_per_task: int | None = None) -> DataFrame:
    """Lines of claim_ids with several lines or no claim, and lines without a claim_id.

    The few such claim_ids fill a filter, and only lines that pass it are shuffled to the join.
    """
    line = ["remit_id", "claim_id", "payer_id", "check_eft_number", "remit_date", "paid_amount",
            "line_no"]
    claim = ["payer_name", "date_of_service", "cpt_code", "billed_amount"]
    facts = (grain.filter("remit_line_count > 1 or (not in_claims and remit_line_count > 0)")
             .selectExpr("claim_id", "remit_line_count", "in_claims",
                         *[f"{c} as claim_{c}" for c in claim]))
    known = may_match(remits.filter("claim_id is not null").select(*line), facts, ["claim_id"])
    matched = spread_join(known, facts, ["claim_id"], "remit_line_count", "line_no", rows_per_task)
    unnamed = (remits.filter("claim_id is null")
               .selectExpr(*line, "false as in_claims"))
    lines = matched.unionByName(unnamed, allowMissingColumns=True)
    names = payers.selectExpr("payer_id", "payer_name as master_payer_name")
    return lookup(lines, names, "payer_id", "line_no", payers_small, rows_per_task)


def typed_grain(claims: DataFrame, lines: DataFrame, payers: DataFrame, payers_small: bool,
                rows_per_task: int | None = None) -> DataFrame:
    """The grain of typed feeds, with `payer_known`."""
    return _grain(claims_by_id(claims), remit_totals(lines), payers, payers_small, rows_per_task)


def landed_grain(claims: DataFrame, lines: DataFrame, payers: DataFrame, payers_small: bool,
                 rows_per_task: int | None = None) -> DataFrame:
    """`typed_grain` of landed claims and typed lines that lie in no order."""
    lines = lines.filter("claim_id is not null")
    seen = repeated_ids(claims.selectExpr("trim(claim_id) as claim_id"), lines)
    # Claims are dealt before they are typed, so that no row is typed twice.
    single, repeated = map(typed_claims, alone_and_repeated(claims, "trim(claim_id)", seen))
    lone, several = alone_and_repeated(lines, seen=seen)
    return _dealt_grain(single, repeated, lone, several, payers, payers_small, rows_per_task)


def bucketed_grain(claims: DataFrame, lines: DataFrame, payers: DataFrame, payers_small: bool,
                   rows_per_task: int | None = None) -> DataFrame:
    """`typed_grain` of typed feeds that lie in buckets of claim_id, without an exchange."""
    seen = repeated_ids(claims, lines, bucketed=True)
    single, repeated = alone_and_repeated(claims, seen=seen)
    lone, several = alone_and_repeated(lines, seen=seen)
    return _dealt_grain(single, repeated, lone, several, payers, payers_small, rows_per_task)


def _dealt_grain(single: DataFrame, repeated: DataFrame, lone: DataFrame, several: DataFrame,
                 payers: DataFrame, payers_small: bool, rows_per_task: int | None) -> DataFrame:
    """The grain of claims and lines of ids that are alone in both feeds, and of the other ids.

    Only the latter are aggregated, which sorts whole rows. The others, nearly all, are joined as they
    are.
    """
    alone = _grain(claims_alone(single), totals_alone(lone), payers, payers_small, rows_per_task)
    return alone.unionByName(_grain(claims_by_id(repeated), remit_totals(several), payers, payers_small,
                                    rows_per_task))


def _grain(unique: DataFrame, totals: DataFrame, payers: DataFrame, payers_small: bool,
           rows_per_task: int | None) -> DataFrame:
    known = payers.selectExpr("payer_id", "true as payer_known")
    return audit_grain(lookup(unique, known, "payer_id", "claim_id", payers_small, rows_per_task),
                       totals)


# Inputs that a table of the layer depends on, where it does not depend on all of them.
LAYER_READS = {"remits": ("payments_remittance",)}


def build_layer(spark: SparkSession, claims: DataFrame, remits: DataFrame, payers: DataFrame,
                path: str | None = None, rows_per_task: int | None = None,
                keep: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> Layer:
    """Type, de-duplicate, roll up and reconcile the landed feeds; write the layer to `path`.

    `keep(table, build)` stores a table in another way and gives it back; it need not call `build`
    for a table that it still has.
    """
    path = path or scratch_path(spark, "layer")
    keep = keep or (lambda table, build: store(build(), f"{path}/{table}"))
    payers_small = is_small(payers)

    lines = keep("remits", lambda: typed_remits(remits).withColumn(
        "line_no", F.monotonically_increasing_id()))
    grain = keep("grain", lambda: landed_grain(claims, lines, payers, payers_small, rows_per_task))
    # Few lines are flagged, spread over every split: `rebalance` gathers them into full files.
    flagged = keep("flagged", lambda: flagged_lines(
        lines, grain, payers, payers_small, rows_per_task).hint("rebalance"))
    return Layer(grain, lines, flagged, payers, path, rows_per_task)


def open_layer(spark: SparkSession, payers: DataFrame, path: str,
               rows_per_task: int | None = None) -> Layer:
    """The layer that `build_layer` wrote to `path`."""
    return Layer(*[spark.read.parquet(f"{path}/{t}") for t in ("grain", "remits", "flagged")],
                 payers, path, rows_per_task)
