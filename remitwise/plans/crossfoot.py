"""Independent recomputation of the payment checks, and the tables of the audit workbook."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.functions.scalars import sql_money, sql_rate, sql_zero
from remitwise.plans.reports import IMPACT, aggregate, grouped, sql_count
from remitwise.schemas import TOTAL

# The verdict that goes with each payment check, and what the check tests.
PAYMENT_CHECKS = [
    ("DQ-05", "NO REMITTANCE (PAID)", "Claim marked PAID, no remittance line"),
    ("DQ-06", "MISMATCH", "Billed ≠ paid + patient resp + adjustment"),
    ("DQ-07", "OVERPAYMENT", "Paid exceeds the billed charge"),
]
# Verdicts that go with no payment check at all.
QUIET_VERDICTS = ["BALANCED", "INVALID CHARGE", "NO REMITTANCE", "DUPLICATE POSTING"]


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def recon_verdict(recon: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """A verdict per claim from the raw amounts, without use of the checks or their variance."""
    return with_verdict(recon.select("claim_id", "claim_status", "billed_amount",
                                     "remit_line_count", "paid_total", "patient_resp_total",
                                     "adjustment_total"), tolerance).drop(
        "patient_resp_total", "adjustment_total")


def with_verdict(recon: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Reconciled claims with `recomputed_accounted`, `recomputed_variance` and `verdict`."""
    accounted = sql_money(" + ".join(
        sql_zero(c) for c in ("paid_total", "patient_resp_total", "adjustment_total")))
    variance = sql_money(f"{sql_zero('billed_amount')} - recomputed_accounted")
    verdict = f"""case
        when billed_amount is null or billed_amount <= 0 then 'INVALID CHARGE'
        when remit_line_count = 0 and claim_status = 'PAID' then 'NO REMITTANCE (PAID)'
        when remit_line_count = 0 then 'NO REMITTANCE'
        when remit_line_count > 1 then 'DUPLICATE POSTING'
        when {sql_zero('paid_total')} > billed_amount then 'OVERPAYMENT'
        when abs(recomputed_variance) > {tolerance:f} then 'MISMATCH'
        else 'BALANCED' end as verdict"""
    return (recon.selectExpr("*", f"{accounted} as recomputed_accounted")
            .selectExpr("*", f"{variance} as recomputed_variance")
            .selectExpr("*", verdict))


def crossfoot_detail(recon: DataFrame, register: DataFrame,
                     tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Verdict against register, claim by claim: AGREE or CHECK."""
    checks = _listed([c for c, _, _ in PAYMENT_CHECKS])
    # A claim in more than one of the payment checks shows the first of them.
    held = grouped(register.filter(f"check_id in {checks} and claim_id is not null"),
                   ["claim_id"], "min(check_id) as register_check")
    pairs = " or ".join([f"verdict in {_listed(QUIET_VERDICTS)} and register_check is null",
                         *[f"verdict = '{v}' and register_check <=> '{c}'"
                           for c, v, _ in PAYMENT_CHECKS]])
    return (recon_verdict(recon, tolerance).join(held, "claim_id", "left")
            .selectExpr("*", f"if({pairs}, 'AGREE', 'CHECK') as agreement"))


def crossfoot_summary(detail: DataFrame, register: DataFrame) -> DataFrame:
    """Register count against recomputed count per payment check, and all claims together."""
    checks = detail.sparkSession.createDataFrame(
        PAYMENT_CHECKS, "check_id string, verdict string, tests string")
    found = grouped(register, ["check_id"], "count(*) as found")
    seen = grouped(detail, ["verdict"], "count(*) as seen")
    per_check = (checks.join(F.broadcast(found), "check_id", "left")
                 .join(F.broadcast(seen), "verdict", "left")
                 .selectExpr("check_id", "tests", f"{sql_count('found')} as register_count",
                             f"{sql_count('seen')} as recomputed_count",
                             f"{sql_count('found')} - {sql_count('seen')} as difference"))
    overall = aggregate(
        detail, "'ALL' as check_id", "'Recomputed verdict vs register, every claim' as tests",
        "count(*) as register_count",
        "count(*) filter (where agreement = 'AGREE') as recomputed_count",
        "count(*) filter (where agreement = 'CHECK') as difference")
    return per_check.unionByName(overall).selectExpr(
        "*", "if(difference = 0, 'AGREE', 'INVESTIGATE') as status")


def check_summary(summary: DataFrame, routing: DataFrame) -> DataFrame:
    """The run summary with owning queue, and a TOTAL row."""
    per_check = ["check_name", "dimension", "severity", "exception_rate_pct", "result",
                 "failure_condition", "escalation"]
    rows = summary.join(F.broadcast(routing), "check_id").rollup("check_id").agg(
        *[F.expr(f"min({c}) as {c}") for c in [*per_check, "assigned_queue"]],
        F.expr("sum(exceptions_found) as exceptions"),
        F.expr(f"cast(sum(financial_impact_usd) as {TOTAL}) as financial_exposure_usd"),
        F.expr("grouping(check_id) as is_total"))
    return rows.selectExpr(
        "check_id", *[f"if(is_total = 0, {c}, null) as {c}" for c in per_check],
        "if(is_total = 0, assigned_queue, 'TOTAL') as assigned_queue", "exceptions",
        "financial_exposure_usd")


def defect_log(register: DataFrame, catalog: DataFrame, routing: DataFrame,
               raised: dt.date) -> DataFrame:
    """One defect per check, with volume and exposure from the register."""
    found = grouped(register, ["check_id"], "count(*) as found", f"{IMPACT} as exposure")
    return (catalog.join(F.broadcast(routing), "check_id")
            .join(F.broadcast(found), "check_id", "left")
            .selectExpr("concat('DEF-0', substr(check_id, 4, 2)) as defect_id",
                        f"date'{raised.isoformat()}' as raised", "check_id",
                        "check_name as defect_title", "severity", "root_cause",
                        f"{sql_count('found')} as volume",
                        f"{sql_zero('exposure')} as financial_exposure_usd", "assigned_queue",
                        "sla_label as target_sla", "'OPEN' as status",
                        "concat('output/exceptions/evidence=', evidence) as evidence_file"))


def severity_mix(register: DataFrame, catalog: DataFrame) -> DataFrame:
    """Exceptions, share and exposure per severity, and a TOTAL row."""
    return severity_rows(
        grouped(register, ["severity"], "count(*) as found", f"{IMPACT} as impact"), catalog)


def severity_rows(found: DataFrame, catalog: DataFrame) -> DataFrame:
    """`severity_mix` from `found` and `impact` per severity."""
    listed = catalog.select("severity").distinct().join(F.broadcast(found), "severity", "left")
    rows = listed.rollup("severity").agg(
        F.expr(f"{sql_count('sum(found)')} as exceptions"),
        F.expr(f"cast({sql_zero('sum(impact)')} as {TOTAL}) as financial_exposure_usd"),
        F.expr("grouping(severity) as is_total"))
    # Four rows, so one window over all of them is safe.
    overall = "max(if(is_total = 1, exceptions, null)) over ()"
    return rows.selectExpr(
        "if(is_total = 1, 'TOTAL', severity) as severity", "exceptions",
        f"{sql_rate('exceptions', overall, 100, 1)} as share_pct", "financial_exposure_usd")


def payer_scorecard_total(recon: DataFrame, register: DataFrame, payers: DataFrame) -> DataFrame:
    """Payer rows recomputed from both tables (NULL payer as its own row), and a TOTAL row.

    A payer with exceptions but no claims is listed too, so that the total is the register's.
    """
    return scorecard_total_rows(
        grouped(recon, ["payer_id"], "count(*) as claims",
                f"cast(sum({sql_zero('billed_amount')}) as {TOTAL}) as billed"),
        grouped(register, ["payer_id"], "count(*) as found", f"{IMPACT} as impact"), payers)


def scorecard_total_rows(claims: DataFrame, found: DataFrame, payers: DataFrame) -> DataFrame:
    """`payer_scorecard_total` from `claims` and `billed`, `found` and `impact` per payer_id."""
    claims = claims.withColumnRenamed("payer_id", "claim_payer")
    found = found.withColumnRenamed("payer_id", "found_payer")
    names = payers.selectExpr("payer_id as known_payer", "payer_name")
    unknown = "Unmapped / unknown payer"
    rows = (claims.join(found, F.expr("claim_payer <=> found_payer"), "full")
            .join(names, F.expr("coalesce(claim_payer, found_payer) = known_payer"), "left")
            .selectExpr("coalesce(claim_payer, found_payer, 'UNMAPPED') as payer_id",
                        f"coalesce(payer_name, '{unknown}') as payer_name",
                        "claims", "billed", "found", "impact"))
    summed = rows.rollup("payer_id").agg(
        F.expr("min(payer_name) as payer_name"),
        F.expr(f"{sql_count('sum(claims)')} as claims"),
        F.expr(f"cast({sql_zero('sum(billed)')} as {TOTAL}) as billed_total"),
        F.expr(f"{sql_count('sum(found)')} as exceptions"),
        F.expr(f"cast({sql_zero('sum(impact)')} as {TOTAL}) as financial_exposure_usd"),
        F.expr("grouping(payer_id) as is_total"))
    per_thousand = f"coalesce({sql_rate('exceptions', 'claims', 1000, 1)}, 0.0)"
    return summed.selectExpr(
        "payer_id", "if(is_total = 1, 'TOTAL', payer_name) as payer_name", "claims",
        "billed_total", "exceptions", "financial_exposure_usd",
        f"if(is_total = 0, {per_thousand}, null) as exceptions_per_1000_claims")


def headline(grain: DataFrame, register: DataFrame, remits: DataFrame) -> DataFrame:
    """The eight headline figures in one row, from the layer's grain and lines and the register."""
    net = "sum(balance_variance) filter (where remit_line_count > 0)"
    return headline_row(
        aggregate(grain.filter("in_claims"), "count(*) as claims",
                  "coalesce(sum(occurrences), 0L) as claim_rows",
                  f"cast({sql_zero('sum(billed_amount)')} as {TOTAL}) as billed",
                  f"cast({sql_zero(net)} as {TOTAL}) as net_variance"),
        aggregate(register, "count(*) as found",
                  "count(*) filter (where severity = 'CRITICAL') as critical",
                  f"{sql_zero(IMPACT)} as impact"), remits)


def headline_row(claims: DataFrame, found: DataFrame, remits: DataFrame) -> DataFrame:
    """`headline` from one row about the claims and one about the register."""
    received = aggregate(remits, "count(*) as remit_rows")
    return claims.crossJoin(found).crossJoin(received).selectExpr(
        "claims as unique_claims", "claim_rows + remit_rows as rows_compared",
        "found as exceptions", f"{sql_rate('found', 'claims', 100, 1)} as exception_rate_pct",
        "critical as critical_exceptions", "impact as financial_exposure_usd",
        "billed as billed_in_scope", "net_variance as net_variance_adjudicated")
