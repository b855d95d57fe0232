"""The twelve checks. Each returns the uniform exception record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.functions.scalars import (CPT_TEXT, ICD10_TEXT, NPI_TEXT, sql_any, sql_fill,
                                         sql_matches, sql_money, sql_npi_is_valid, sql_zero)
from remitwise.operators.bloom import may_match
from remitwise.operators.layers import Layer, store
from remitwise.operators.skew import repeats, spread_join
from remitwise.schemas import EXCEPTION_COLUMNS, MONEY, SEVERITY, TOTAL
from remitwise.sources.scratch import scratch_path


@dataclass(frozen=True)
class Params:
    """What a run may set: the audit date and the two money thresholds."""

    audit_date: dt.date
    tolerance: Decimal = Decimal("0.01")
    contract_floor: Decimal = Decimal("0.90")


@dataclass(frozen=True)
class Rule:
    """A check on one row of the claim grain, as SQL text."""

    check_id: str
    fails: str
    impact: str
    finding: str
    # A listed finding is empty where the row passes.
    listed: bool = False


def _listed(check_id: str, issues: list[tuple[str, str]], impact: str) -> Rule:
    """A rule that lists every broken condition of a claim in one finding."""
    listed = ", ".join(f"case when {broken} then {text} end" for broken, text in issues)
    return Rule(check_id, sql_any([broken for broken, _ in issues]), impact,
                f"concat_ws('; ', {listed})", True)


def _temporal_issues(params: Params) -> list[tuple[str, str]]:
    audit_date = f"date'{params.audit_date.isoformat()}'"
    return [
        # Some remittance predates the service exactly when the first one does.
        ("first_remit_date < date_of_service",
         "'remittance dated before the date of service'"),
        ("claim_submit_date < date_of_service",
         sql_fill("claim submitted {}, before the date of service {}",
                  "claim_submit_date", "date_of_service")),
        (f"date_of_service > {audit_date}",
         sql_fill("date of service {} is in the future (audit date {})",
                  "date_of_service", audit_date)),
    ]


def _field_issues() -> list[tuple[str, str]]:
    cpt, icd10 = "trim(cpt_code_raw)", "trim(icd10_code_raw)"
    return [
        ("patient_id is null", "'patient_id blank'"),
        ("date_of_service is null", "'date_of_service blank or unparseable'"),
        ("cpt_code is null", "'cpt_code blank'"),
        (f"cpt_code is not null and not {sql_matches(cpt, CPT_TEXT)}",
         sql_fill('cpt_code "{}" is malformed', cpt)),
        ("icd10_code is null", "'icd10_code blank'"),
        (f"icd10_code is not null and not {sql_matches(icd10, ICD10_TEXT)}",
         sql_fill('icd10_code "{}" is malformed', icd10)),
        ("billed_amount is null", "'billed_amount blank or unparseable'"),
        ("billed_amount <= 0", sql_fill("billed_amount is {}", "billed_amount")),
    ]


def claim_rules(params: Params) -> dict[str, Rule]:
    """The nine checks that need one grain row only."""
    overpaid = sql_money("paid_total - billed_amount")
    shortfall = "(expected_allowed_amount - allowed_total)"
    # A shortfall that is reported is smaller than the expected amount, so the narrow type holds it.
    below_pct = (f"cast(round(100 * try_cast({shortfall} as {MONEY}) "
                 "/ nullif(expected_allowed_amount, 0), 1) as decimal(18,1))")
    rules = [
        Rule("DQ-01",
             "occurrences > 1 and claim_id is not null",
             sql_money(f"{sql_zero('max_billed_amount')} "
                       "* cast(occurrences - 1 as decimal(18,0))"),
             sql_fill("claim_id received {} times (source systems: {}; batches: {})",
                      "occurrences", "source_systems", "ingest_batches")),
        Rule("DQ-05",
             "claim_status = 'PAID' and remit_line_count = 0",
             "billed_amount",
             sql_fill("claim status is PAID but no remittance line exists; submitted {}, "
                      "charge {}", "claim_submit_date", "billed_amount")),
        Rule("DQ-06",
             "remit_line_count = 1 and billed_amount > 0 and paid_total <= billed_amount "
             f"and abs(balance_variance) > {params.tolerance:f}",
             "balance_variance",
             sql_fill("billed {} vs accounted {} (paid {} + patient resp {} + adjustment {}); "
                      "variance {}", "billed_amount", "remit_accounted_total", "paid_total",
                      "patient_resp_total", "adjustment_total", "balance_variance")),
        Rule("DQ-07",
             "remit_line_count = 1 and billed_amount > 0 and paid_total > billed_amount",
             overpaid,
             sql_fill("paid {} against a billed charge of {}; overpaid by {} (check {})",
                      "paid_total", "billed_amount", overpaid, "first_check_eft_number")),
        Rule("DQ-08",
             "remit_line_count = 1 and remit_status_code = '1' and allowed_total > 0 "
             "and expected_allowed_amount > 0 "
             f"and allowed_total < expected_allowed_amount * {params.contract_floor:f}",
             sql_money(shortfall),
             sql_fill("allowed {} against a contracted expectation of {} ({}% below contract)",
                      "allowed_total", "expected_allowed_amount", below_pct)),
        Rule("DQ-09",
             "not payer_known",
             "billed_amount",
             "case when payer_id is null then 'payer_id is blank on the claim record' else "
             + sql_fill('payer_id {} is not present in the payer master (claim carries name "{}")',
                        "payer_id", "coalesce(payer_name, '<null>')") + " end"),
        Rule("DQ-10",
             f"not {sql_npi_is_valid('provider_npi')}",
             "billed_amount",
             "case when provider_npi is null then 'provider_npi is blank' "
             f"when not {sql_matches('provider_npi', NPI_TEXT)} then "
             + sql_fill('provider_npi "{}" is not 10 numeric digits', "provider_npi") + " else "
             + sql_fill("provider_npi {} fails the Luhn check digit", "provider_npi") + " end"),
        _listed("DQ-11", _temporal_issues(params), "0"),
        _listed("DQ-12", _field_issues(), sql_zero("billed_amount")),
    ]
    return {r.check_id: r for r in rules}


def _record(check_id: str, entity_type: str, key: str, impact: str, finding: str,
            **columns: str) -> dict[str, str]:
    """The uniform record as SQL text; `columns` replaces columns of the input."""
    values = {
        "check_id": f"'{check_id}'", "severity": f"'{SEVERITY[check_id]}'",
        "entity_type": f"'{entity_type}'", "entity_key": key,
        "amount_impact": f"cast({impact} as {TOTAL})", "finding": finding, **columns,
    }
    return {c: values.get(c, c) for c in EXCEPTION_COLUMNS}


def _select(rows: DataFrame, record: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{value} as {name}" for name, value in record.items()])


def _rule_record(rule: Rule) -> dict[str, str]:
    return _record(rule.check_id, "claim", "claim_id", rule.impact, rule.finding)


def _claim_check(layer: Layer, params: Params, check_id: str) -> DataFrame:
    rule = claim_rules(params)[check_id]
    return _select(layer.claims.filter(rule.fails), _rule_record(rule))


def dq01(layer: Layer, params: Params) -> DataFrame:
    """Duplicate claim identifiers: the same claim_id on more than one row of the extract."""
    return _claim_check(layer, params, "DQ-01")


def dq02(layer: Layer, params: Params) -> DataFrame:
    """Duplicate billing fingerprint: a later claim for a patient, provider, day, code and charge.

    Hashes of the fingerprints are counted first, in a state of fixed size; those seen twice,
    normally few, are written and fill a filter. Only claims that pass it are shuffled, joined to
    the hashes and grouped by the fingerprint itself.
    """
    fingerprint = ["patient_id", "provider_npi", "date_of_service", "cpt_code", "billed_amount"]
    complete = (layer.claims.filter("billed_amount > 0").na.drop(subset=fingerprint)
                .selectExpr(*fingerprint, "claim_id", "claim_submit_date", "payer_id", "payer_name",
                            f"xxhash64({', '.join(fingerprint)}) as hash"))
    seen = store(complete.groupBy("hash").agg(F.expr("count(*) as times")).filter("times > 1"),
                 scratch_path(layer.grain.sparkSession, "hashes"))
    # Written, since they are read up to three times and each time would scan the grain.
    candidates = store(spread_join(may_match(complete, seen, ["hash"]), seen, ["hash"], "times",
                                   "claim_id", layer.rows_per_task),
                       scratch_path(layer.grain.sparkSession, "fingerprints"))
    later = repeats(candidates, fingerprint, ["claim_submit_date", "claim_id"], "claim_id",
                    "claim_id", layer.rows_per_task)
    finding = sql_fill("duplicate of {} - same patient, provider, date of service, CPT and "
                       "charge; submitted {}", "original_claim_id", "claim_submit_date")
    return _select(later, _record("DQ-02", "claim", "claim_id", "billed_amount", finding))


def dq03(layer: Layer, params: Params) -> DataFrame:
    """Duplicate remittance posting: a claim posted again on the same check for the same amount."""
    lines = layer.flagged.filter("remit_line_count > 1")
    later = repeats(lines, ["claim_id", "check_eft_number", "paid_amount"],
                    ["remit_id", "payer_id", "line_no"], "remit_id", "line_no",
                    layer.rows_per_task, null_keys=True)
    finding = sql_fill("second posting of claim {} on check {} for {} (original posting {})",
                       "claim_id", "check_eft_number", "paid_amount", "original_remit_id")
    claim = {c: f"claim_{c}"
             for c in ("payer_name", "date_of_service", "cpt_code", "billed_amount")}
    return _select(later, _record("DQ-03", "remit", "remit_id", "paid_amount", finding, **claim))


def dq04(layer: Layer, params: Params) -> DataFrame:
    """Orphaned remittance: a line whose claim_id is not among the claims, or has none."""
    finding = sql_fill("remittance posted on {} against claim {}, which is absent from the claims "
                       "feed (check {})", "remit_date", "coalesce(claim_id, '<null>')",
                       "check_eft_number")
    return _select(
        layer.flagged.filter("not in_claims"),
        _record("DQ-04", "remit", "remit_id", "paid_amount", finding,
                payer_name="master_payer_name", date_of_service="cast(null as date)",
                cpt_code="cast(null as string)", billed_amount=f"cast(null as {MONEY})"))


def dq05(layer: Layer, params: Params) -> DataFrame:
    """Missing remittance for a claim the billing system calls PAID."""
    return _claim_check(layer, params, "DQ-05")


def dq06(layer: Layer, params: Params) -> DataFrame:
    """Claim-to-payment mismatch: one line, not overpaid, variance beyond the tolerance."""
    return _claim_check(layer, params, "DQ-06")


def dq07(layer: Layer, params: Params) -> DataFrame:
    """Overpayment: one line that pays more than the charge."""
    return _claim_check(layer, params, "DQ-07")


def dq08(layer: Layer, params: Params) -> DataFrame:
    """Allowed amount below the contract floor on an adjudicated claim."""
    return _claim_check(layer, params, "DQ-08")


def dq09(layer: Layer, params: Params) -> DataFrame:
    """Unmapped payer: payer_id blank or not in the payer master."""
    return _claim_check(layer, params, "DQ-09")


def dq10(layer: Layer, params: Params) -> DataFrame:
    """Invalid provider NPI."""
    return _claim_check(layer, params, "DQ-10")


def dq11(layer: Layer, params: Params) -> DataFrame:
    """Temporal integrity break, one row per claim with every broken rule."""
    return _claim_check(layer, params, "DQ-11")


def dq12(layer: Layer, params: Params) -> DataFrame:
    """Missing or malformed mandatory field, one row per claim with every bad field."""
    return _claim_check(layer, params, "DQ-12")


CHECKS = {
    "DQ-01": dq01, "DQ-02": dq02, "DQ-03": dq03, "DQ-04": dq04, "DQ-05": dq05, "DQ-06": dq06,
    "DQ-07": dq07, "DQ-08": dq08, "DQ-09": dq09, "DQ-10": dq10, "DQ-11": dq11, "DQ-12": dq12,
}


def all_exceptions(layer: Layer, params: Params) -> DataFrame:
    """The twelve checks as separate branches."""
    return reduce(DataFrame.unionByName, [check(layer, params) for check in CHECKS.values()])


def all_exceptions_fused(layer: Layer, params: Params) -> DataFrame:
    """The same rows, with the nine claim checks done in one scan of the grain."""
    return reduce(DataFrame.unionByName, exceptions_by_entity(layer, params))


def exceptions_by_entity(layer: Layer, params: Params) -> tuple[DataFrame, DataFrame]:
    """The exceptions of claims, no two of which are equal, and those of remittance lines.

    The grain has one row per claim_id and a check reports it once; lines may be copies of one
    another. A claim without findings, nearly every claim, leaves at the filter and builds no record.
    """
    rules = claim_rules(params).values()
    # Whatever all rules share stays outside the array, and a condition that the finding lists again is
    # not tested before it: a generated method above 8,000 bytes is never compiled.
    own = ("check_id", "severity", "amount_impact", "finding")
    records = []
    for rule in rules:
        record = _rule_record(rule)
        if rule.listed:
            record["finding"] = f"nullif({rule.finding}, '')"
        fields = f"struct({', '.join(f'{record[name]} as {name}' for name in own)})"
        records.append(fields if rule.listed else f"case when {rule.fails} then {fields} end")
    claim_records = (layer.claims.filter(sql_any([r.fails for r in rules]))
                     .selectExpr(*[f"{value} as {name}" for name, value in record.items()
                                   if name not in own],
                                 f"explode(array({', '.join(records)})) as record")
                     .filter("record.finding is not null")
                     .selectExpr(*[f"record.{c}" if c in own else c for c in EXCEPTION_COLUMNS]))
    return (claim_records.unionByName(dq02(layer, params)),
            dq03(layer, params).unionByName(dq04(layer, params)))
