"""Run summary, control totals, payer scorecard and the scoring of the checks themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.functions.scalars import sql_rate, sql_zero
from remitwise.schemas import TOTAL

IMPACT = f"cast(sum(abs(amount_impact)) as {TOTAL})"
PAYER = "coalesce(payer_id, 'UNMAPPED')"


def aggregate(df: DataFrame, *measures: str) -> DataFrame:
    """Global aggregates given as SQL text."""
    return df.agg(*[F.expr(m) for m in measures])


def grouped(df: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    """Aggregates by columns or expressions, all given as SQL text."""
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*[F.expr(m) for m in measures])


def sql_count(c: str) -> str:
    """Count with NULL as zero."""
    return f"coalesce({c}, 0L)"


def dq_summary(register: DataFrame, claim_unique: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per check, also for checks without findings."""
    return summary_rows(
        grouped(register, ["check_id"], "count(*) as found", "count(distinct claim_id) as claims",
                f"{IMPACT} as impact"),
        aggregate(claim_unique, "count(*) as claims"), catalog)


def summary_rows(found: DataFrame, reviewed: DataFrame, catalog: DataFrame) -> DataFrame:
    """`dq_summary` from `found`, `claims` and `impact` per check and the one row of claims reviewed."""
    reviewed = reviewed.selectExpr("claims as claims_reviewed")
    found_n = sql_count("found")
    # `found` has at most one row per check, `reviewed` one row.
    return (catalog.join(F.broadcast(found), "check_id", "left")
            .crossJoin(F.broadcast(reviewed))
            .selectExpr("check_id", "check_name", "dimension", "severity",
                        f"{found_n} as exceptions_found",
                        f"{sql_count('claims')} as claims_affected",
                        f"{sql_zero('impact')} as financial_impact_usd",
                        f"{sql_rate(found_n, 'claims_reviewed', 100, 3)} as exception_rate_pct",
                        f"if({found_n} = 0, 'PASS', 'FAIL') as result",
                        "failure_condition", "escalation"))


def control_totals(recon: DataFrame) -> DataFrame:
    """How much of the billed book the remittances account for."""
    billed, allowed, paid = (sql_zero(c) for c in ("billed_amount", "allowed_total", "paid_total"))
    patient, adjusted = sql_zero("patient_resp_total"), sql_zero("adjustment_total")

    def total(value: str, name: str, where: str = "true") -> str:
        return f"cast(sum({value}) filter (where {where}) as {TOTAL}) as {name}"

    matched = "remit_line_count > 0"
    return aggregate(
        recon,
        "count(*) as claims_in_scope",
        f"count(*) filter (where {matched}) as claims_with_remittance",
        "count(*) filter (where remit_line_count = 0) as claims_without_remittance",
        total(billed, "billed_total"), total(allowed, "allowed_total"), total(paid, "paid_total"),
        total(patient, "patient_responsibility_total"), total(adjusted, "adjustment_total"),
        total(f"{billed} - ({paid} + {patient} + {adjusted})", "unreconciled_variance"),
        total(billed, "billed_total_adjudicated", matched),
        total("balance_variance", "variance_adjudicated", matched),
        total("abs(balance_variance)", "abs_variance_adjudicated", matched))


def payer_scorecard(claim_unique: DataFrame, register: DataFrame, payers: DataFrame) -> DataFrame:
    """Claims, exceptions and impact per payer; payers without claims are left out."""
    return scorecard_rows(
        grouped(claim_unique, [f"{PAYER} as payer_id"], "count(*) as claims",
                f"cast(sum({sql_zero('billed_amount')}) as {TOTAL}) as billed"),
        grouped(register, [f"{PAYER} as payer_id"], "count(*) as found", f"{IMPACT} as impact"),
        payers)


def scorecard_rows(claims: DataFrame, found: DataFrame, payers: DataFrame) -> DataFrame:
    """`payer_scorecard` from `claims` and `billed`, `found` and `impact` per payer."""
    found_n = sql_count("found")
    return (claims.join(found, "payer_id", "left")
            .join(payers.select("payer_id", "payer_name"), "payer_id", "left")
            .selectExpr("payer_id",
                        "coalesce(payer_name, 'Unmapped / unknown payer') as payer_name",
                        "claims", "billed as billed_total", f"{found_n} as exceptions",
                        f"{sql_zero('impact')} as financial_impact_usd",
                        f"{sql_rate(found_n, 'claims', 1000, 1)} as exceptions_per_1000_claims"))


def suite_validation(catalog: DataFrame, ledger: DataFrame, register: DataFrame) -> DataFrame:
    """Recall and precision of every check against the planted defects."""
    planted = ledger.select("check_id", "entity_key").distinct()
    reported = register.select("check_id", "entity_key").distinct()
    injected = grouped(ledger, ["check_id"], "count(*) as injected")
    detected = grouped(reported, ["check_id"], "count(entity_key) as detected")
    # An inner join, not `intersect`: a NULL key matches nothing.
    hits = grouped(planted.join(reported, ["check_id", "entity_key"]), ["check_id"],
                   "count(*) as hits")
    scored = catalog
    for part in (injected, detected, hits):
        scored = scored.join(F.broadcast(part), "check_id", "left")  # one row per check
    planted_n, found_n, hit_n = (sql_count(c) for c in ("injected", "detected", "hits"))
    return scored.selectExpr(
        "check_id", "check_name", f"{planted_n} as injected_defects",
        f"{found_n} as detected_exceptions", f"{hit_n} as true_positives",
        f"{planted_n} - {hit_n} as false_negatives", f"{found_n} - {hit_n} as false_positives",
        f"{sql_rate(hit_n, planted_n, 100, 1)} as recall_pct",
        f"{sql_rate(hit_n, found_n, 100, 1)} as precision_pct",
        f"if({planted_n} = {hit_n} and {found_n} = {hit_n}, 'PASS', 'REVIEW') as suite_result")


def negative_control(exceptions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Findings per check on clean data, where every count must be zero."""
    found = grouped(exceptions, ["check_id"], "count(*) as found")
    return catalog.join(F.broadcast(found), "check_id", "left").selectExpr(
        "check_id", f"{sql_count('found')} as false_positives",
        f"if({sql_count('found')} = 0, 'PASS', 'FAIL') as result")
