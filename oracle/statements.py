"""One DuckDB statement per query. Each is a chain of named steps ending in a SELECT."""

from __future__ import annotations

from remitwise import schemas
from remitwise.fixture import BAD_NPI, CPT_ROWS, NPIS, PAYER_ROWS

MONEY = "DECIMAL(18,2)"
AUDIT_DATE = "2001-12-31"
RUN_ID = "RUN-2001-12-31"
RUN_TS = "2001-12-31 06:00:00"
AS_OF = "2002-01-04 12:00:00"
# A run id that cannot be a folder name as it is.
ODD_RUN = "RUN 2001/12=31: 50%25"


def _quoted(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in row) + ")"
        for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _choice(values: list[str], index: str) -> str:
    return "CASE " + index + " " + " ".join(
        f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values)) + " END"


def _money(c: str) -> str:
    return f"CAST({c} AS {MONEY})"


def _total(c: str) -> str:
    return f"CAST({c} AS DECIMAL(38,2))"


def _pct(n: str, d: str, factor: str, digits: int) -> str:
    return (f"CAST(round({factor} * {n} / nullif({d}, 0), {digits}) AS DECIMAL(18,{digits}))")


MASTER = {
    "payer": _values(PAYER_ROWS, "payer_id, payer_name, payer_type, contract_rate"),
    "catalog": _values(schemas.CATALOG, "check_id, check_name, dimension, severity, "
                                        "failure_condition, escalation"),
    "routing": _values(schemas.ROUTING, "check_id, assigned_queue, sla_label, sla_business_days, "
                                        "finding_class, evidence, root_cause"),
}


def feeds(defects: bool = True) -> dict[str, str]:
    """Steps that derive both feeds from `orders`."""
    npi = _choice(NPIS, "k % 5")
    return {
        "o": f"""SELECT o_orderkey AS k, {'o_orderkey % 100' if defects else '-1'} AS r,
            CAST(o_orderdate AS DATE) AS dos,
            'CLM-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS cid,
            {_money('100 + o_orderkey % 400')} AS billed,
            {_money("(100 + o_orderkey % 400) * 0.60")} AS expected,
            CASE WHEN o_orderkey % 100 BETWEEN 90 AND 95 THEN 'PENDING'
                 WHEN o_orderkey % 100 >= 96 THEN 'DENIED' ELSE 'PAID' END AS status
            FROM orders""",
        "claim0": f"""SELECT r, cid AS claim_id,
            CASE WHEN r = 12 AND k % 500 = 12 THEN '' ELSE 'PT-' || k END AS patient_id,
            'ENC-' || k AS encounter_id,
            CASE WHEN r = 10 AND k % 200 = 10 THEN left({npi}, 9)
                 WHEN r = 10 THEN '{BAD_NPI}' ELSE {npi} END AS provider_npi,
            'FAC-0' || (1 + k % 5) AS facility_id, '11' AS place_of_service,
            CASE WHEN r = 9 AND k % 200 = 9 THEN '' WHEN r = 9 THEN 'PAY-XXX-999'
                 ELSE {_choice([p[0] for p in PAYER_ROWS], 'k % 9')} END AS payer_id,
            CASE WHEN r = 9 THEN 'UNMAPPED'
                 ELSE {_choice([p[1] for p in PAYER_ROWS], 'k % 9')} END AS payer_name,
            CASE WHEN r = 11 AND k % 200 = 11 THEN '2026-09-29' WHEN r = 13 THEN ''
                 ELSE CAST(dos AS VARCHAR) END AS date_of_service,
            CAST(CASE WHEN r = 14 THEN dos - 3 ELSE dos + CAST(1 + k % 10 AS INTEGER) END
                 AS VARCHAR) AS claim_submit_date,
            CASE WHEN r = 15 THEN 'ABCDE' ELSE '99213' END AS cpt_code,
            CASE WHEN r = 16 THEN 'E119' ELSE 'E11.9' END AS icd10_code, '1' AS units,
            CASE WHEN r = 17 THEN '-125.00' ELSE CAST(billed AS VARCHAR) END AS billed_amount,
            CAST(expected AS VARCHAR) AS expected_allowed_amount, status AS claim_status,
            'EPIC_PB' AS source_system, 'BATCH-1' AS ingest_batch_id,
            CAST(dos + 20 AS VARCHAR) AS rebilled_on FROM o""",
        "claims": """SELECT * EXCLUDE (r, rebilled_on) FROM claim0
            UNION ALL SELECT * EXCLUDE (r, rebilled_on) REPLACE ('ATHENA_PM' AS source_system,
                'BATCH-1-R' AS ingest_batch_id) FROM claim0 WHERE r = 1
            UNION ALL SELECT * EXCLUDE (r, rebilled_on) REPLACE (
                'CLM-9' || substr(claim_id, 6) AS claim_id, rebilled_on AS claim_submit_date,
                'PENDING' AS claim_status, 'BATCH-2' AS ingest_batch_id) FROM claim0 WHERE r = 2""",
        "allowed": f"""SELECT *, {_money('''CASE WHEN status = 'DENIED' THEN 0
            WHEN r = 7 THEN billed + 50 WHEN r = 8 THEN expected * 0.80 ELSE expected END''')} AS al
            FROM o WHERE status <> 'PENDING' AND r <> 5""",
        "remit0": f"""SELECT r, 'RMT-' || k AS remit_id, cid AS claim_id,
            {_choice([p[0] for p in PAYER_ROWS], 'k % 9')} AS payer_id,
            'EFT' || k AS check_eft_number,
            CAST(CASE WHEN r = 18 THEN dos - 5 ELSE dos + 30 END AS VARCHAR) AS remit_date,
            CAST(al AS VARCHAR) AS allowed_amount,
            CAST({_money('CASE WHEN r = 6 THEN expected - 5 ELSE al END')} AS VARCHAR)
                AS paid_amount,
            '0.00' AS patient_responsibility,
            CAST({_money('CASE WHEN r = 7 THEN 0 ELSE billed - al END')} AS VARCHAR)
                AS contractual_adjustment,
            CASE WHEN status = 'DENIED' THEN '16' ELSE '45' END AS carc_code,
            CASE WHEN status = 'DENIED'
                 THEN 'Claim lacks information or has submission/billing error'
                 ELSE 'Charge exceeds fee schedule/contracted rate' END AS carc_description,
            CASE WHEN status = 'DENIED' THEN '4' ELSE '1' END AS claim_status_code,
            'Y' AS posted_flag, 'ERA-1' AS ingest_batch_id FROM allowed""",
        "remits": """SELECT * EXCLUDE (r) FROM remit0
            UNION ALL SELECT * EXCLUDE (r) REPLACE ('RMT-D' || substr(remit_id, 5) AS remit_id)
                FROM remit0 WHERE r = 3
            UNION ALL SELECT * EXCLUDE (r) REPLACE ('RMT-G' || substr(remit_id, 5) AS remit_id,
                'CLM-8' || substr(claim_id, 6) AS claim_id) FROM remit0 WHERE r = 4""",
    }


LEDGER = {
    "ledger": """SELECT 'INJ-' || k AS defect_ref,
        CASE WHEN r BETWEEN 1 AND 10 THEN 'DQ-' || lpad(CAST(r AS VARCHAR), 2, '0')
             WHEN r IN (11, 14, 18) THEN 'DQ-11' ELSE 'DQ-12' END AS check_id,
        CASE WHEN r IN (3, 4) THEN 'remit' ELSE 'claim' END AS entity_type,
        CASE r WHEN 2 THEN 'CLM-9' || substr(cid, 6) WHEN 3 THEN 'RMT-D' || k
               WHEN 4 THEN 'RMT-G' || k ELSE cid END AS entity_key
        FROM o WHERE r BETWEEN 1 AND 10 OR r IN (13, 14, 15, 16, 17, 18)
            OR (r = 11 AND k % 200 = 11) OR (r = 12 AND k % 500 = 12)""",
}


def _text(c: str) -> str:
    return f"nullif(trim({c}), '') AS {c}"


def _date(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[1-9][0-9]{{3}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
            f"THEN TRY_CAST(trim({c}) AS DATE) END AS {c}")


def _amount(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN TRY_CAST(trim({c}) AS {MONEY}) END AS {c}")


TYPED = {
    "tc": f"""SELECT trim(claim_id) AS claim_id, {_text('patient_id')}, {_text('encounter_id')},
        {_text('provider_npi')}, {_text('facility_id')}, {_text('place_of_service')},
        {_text('payer_id')}, {_text('payer_name')}, {_date('date_of_service')},
        {_date('claim_submit_date')}, {_text('cpt_code')}, {_text('icd10_code')},
        {_amount('units')}, {_amount('billed_amount')}, {_amount('expected_allowed_amount')},
        {_text('claim_status')}, {_text('source_system')}, {_text('ingest_batch_id')},
        date_of_service AS date_of_service_raw, cpt_code AS cpt_code_raw,
        icd10_code AS icd10_code_raw, billed_amount AS billed_amount_raw FROM claims""",
    "tr": f"""SELECT trim(remit_id) AS remit_id, {_text('claim_id')}, {_text('payer_id')},
        {_text('check_eft_number')}, {_date('remit_date')}, {_amount('allowed_amount')},
        {_amount('paid_amount')}, {_amount('patient_responsibility')},
        {_amount('contractual_adjustment')}, {_text('carc_code')}, {_text('carc_description')},
        {_text('claim_status_code')}, {_text('posted_flag')}, {_text('ingest_batch_id')}
        FROM remits""",
}
_TIEBREAK = ", ".join(f"{c} NULLS FIRST" for c in schemas.TYPED_CLAIM_COLUMNS
                      if c not in ("claim_id", "ingest_batch_id", "source_system"))
RECON = {
    "cu": f"""SELECT * FROM tc QUALIFY row_number() OVER (PARTITION BY claim_id
        ORDER BY ingest_batch_id NULLS LAST, source_system NULLS LAST, {_TIEBREAK}) = 1""",
    "rb": f"""SELECT claim_id, count(*) AS remit_line_count,
        {_total('sum(allowed_amount)')} AS allowed_total, {_total('sum(paid_amount)')} AS paid_total,
        {_total('sum(patient_responsibility)')} AS patient_resp_total,
        {_total('sum(contractual_adjustment)')} AS adjustment_total,
        min(remit_date) AS first_remit_date, max(remit_date) AS last_remit_date,
        min(claim_status_code) AS remit_status_code,
        string_agg(DISTINCT carc_code, ',' ORDER BY carc_code) AS carc_codes,
        string_agg(DISTINCT check_eft_number, ',' ORDER BY check_eft_number) AS check_eft_numbers
        FROM tr WHERE claim_id IS NOT NULL GROUP BY claim_id""",
    "rc": f"""SELECT cu.claim_id, patient_id, provider_npi, facility_id, payer_id, payer_name,
        date_of_service, claim_submit_date, cpt_code, claim_status, source_system, billed_amount,
        expected_allowed_amount, coalesce(remit_line_count, 0) AS remit_line_count,
        rb.* EXCLUDE (claim_id, remit_line_count),
        {_total('coalesce(paid_total, 0) + coalesce(patient_resp_total, 0) + coalesce(adjustment_total, 0)')}
            AS remit_accounted_total,
        {_total('billed_amount - coalesce(paid_total, 0) - coalesce(patient_resp_total, 0) - coalesce(adjustment_total, 0)')}
            AS balance_variance
        FROM cu LEFT JOIN rb ON cu.claim_id = rb.claim_id""",
}


def _exception(check_id: str, source: str, impact: str, finding: str, where: str = "true",
               entity: str = "claim", key: str = "claim_id", claim_id: str = "claim_id",
               payer_id: str = "payer_id", payer_name: str = "payer_name",
               dos: str = "date_of_service", cpt: str = "cpt_code",
               billed: str = "billed_amount") -> str:
    return f"""SELECT '{check_id}' AS check_id, '{schemas.SEVERITY[check_id]}' AS severity,
        '{entity}' AS entity_type, {key} AS entity_key, {claim_id} AS claim_id,
        {payer_id} AS payer_id, {payer_name} AS payer_name, {dos} AS date_of_service,
        {cpt} AS cpt_code, {billed} AS billed_amount, {_total(impact)} AS amount_impact,
        {finding} AS finding FROM {source} WHERE {where}"""


_DIGIT = "CAST(substr(provider_npi, {}, 1) AS INTEGER)"
# Check digit by arithmetic: the prefix adds 24, every second digit counts double.
_LUHN = " + ".join(
    f"({_DIGIT.format(i)} * 2 - CASE WHEN {_DIGIT.format(i)} > 4 THEN 9 ELSE 0 END)" if i % 2
    else _DIGIT.format(i) for i in range(1, 11))
_NPI_SHAPE = "regexp_full_match(provider_npi, '[0-9]{10}')"

CHECKS = {
    "DQ-01": _exception(
        "DQ-01", """cu JOIN (SELECT claim_id AS id, count(*) AS n, max(billed_amount) AS top,
            string_agg(DISTINCT source_system, ', ' ORDER BY source_system) AS systems,
            string_agg(DISTINCT ingest_batch_id, ', ' ORDER BY ingest_batch_id) AS batches
            FROM tc GROUP BY claim_id HAVING count(*) > 1) d ON d.id = cu.claim_id""",
        "coalesce(top, 0) * (n - 1)",
        "concat('claim_id received ', n, ' times (source systems: ', systems, '; batches: ', "
        "batches, ')')"),
    "DQ-02": _exception(
        "DQ-02", """(SELECT *, row_number() OVER w AS place, first_value(claim_id) OVER w AS first
            FROM cu WHERE patient_id IS NOT NULL AND provider_npi IS NOT NULL
                AND date_of_service IS NOT NULL AND cpt_code IS NOT NULL AND billed_amount > 0
            WINDOW w AS (PARTITION BY patient_id, provider_npi, date_of_service, cpt_code,
                billed_amount ORDER BY claim_submit_date NULLS LAST, claim_id)) f""",
        "billed_amount",
        "concat('duplicate of ', first, ' - same patient, provider, date of service, CPT and "
        "charge; submitted ', claim_submit_date)", "place > 1"),
    "DQ-03": _exception(
        "DQ-03", """(SELECT *, row_number() OVER w AS place, first_value(remit_id) OVER w AS first
            FROM tr WHERE claim_id IS NOT NULL WINDOW w AS (PARTITION BY claim_id,
                check_eft_number, paid_amount ORDER BY remit_id)) k
            LEFT JOIN cu ON cu.claim_id = k.claim_id""",
        "k.paid_amount",
        "concat('second posting of claim ', k.claim_id, ' on check ', check_eft_number, ' for ', "
        "paid_amount, ' (original posting ', first, ')')", "place > 1",
        entity="remit", key="remit_id", claim_id="k.claim_id", payer_id="k.payer_id",
        payer_name="cu.payer_name"),
    "DQ-04": _exception(
        "DQ-04", """tr LEFT JOIN cu ON cu.claim_id = tr.claim_id
            LEFT JOIN payer p ON p.payer_id = tr.payer_id""",
        "tr.paid_amount",
        "concat('remittance posted on ', remit_date, ' against claim ', "
        "coalesce(tr.claim_id, '<null>'), ', which is absent from the claims feed (check ', "
        "check_eft_number, ')')", "cu.claim_id IS NULL",
        entity="remit", key="remit_id", claim_id="tr.claim_id", payer_id="tr.payer_id",
        payer_name="p.payer_name", dos="CAST(NULL AS DATE)", cpt="CAST(NULL AS VARCHAR)",
        billed=f"CAST(NULL AS {MONEY})"),
    "DQ-05": _exception(
        "DQ-05", "rc", "billed_amount",
        "concat('claim status is PAID but no remittance line exists; submitted ', "
        "claim_submit_date, ', charge ', billed_amount)",
        "claim_status = 'PAID' AND remit_line_count = 0"),
    "DQ-06": _exception(
        "DQ-06", "rc", "balance_variance",
        "concat('billed ', billed_amount, ' vs accounted ', remit_accounted_total, ' (paid ', "
        "paid_total, ' + patient resp ', patient_resp_total, ' + adjustment ', adjustment_total, "
        "'); variance ', balance_variance)",
        "remit_line_count = 1 AND billed_amount > 0 AND paid_total <= billed_amount "
        "AND (balance_variance > 0.01 OR balance_variance < -0.01)"),
    "DQ-07": _exception(
        "DQ-07", "rc", "paid_total - billed_amount",
        f"concat('paid ', paid_total, ' against a billed charge of ', billed_amount, "
        f"'; overpaid by ', {_total('paid_total - billed_amount')}, ' (check ', "
        "check_eft_numbers, ')')",
        "remit_line_count = 1 AND billed_amount > 0 AND paid_total > billed_amount"),
    "DQ-08": _exception(
        "DQ-08", "rc", "expected_allowed_amount - allowed_total",
        "concat('allowed ', allowed_total, ' against a contracted expectation of ', "
        "expected_allowed_amount, ' (', CAST(round(100.0 * (expected_allowed_amount - "
        "allowed_total) / expected_allowed_amount, 1) AS DECIMAL(18,1)), '% below contract)')",
        "remit_line_count = 1 AND remit_status_code = '1' AND allowed_total > 0 "
        "AND expected_allowed_amount > 0 AND allowed_total < 0.90 * expected_allowed_amount"),
    "DQ-09": _exception(
        "DQ-09", "cu", "billed_amount",
        "CASE WHEN payer_id IS NULL THEN 'payer_id is blank on the claim record' ELSE "
        "concat('payer_id ', payer_id, ' is not present in the payer master (claim carries name "
        "\"', coalesce(payer_name, '<null>'), '\")') END",
        "NOT EXISTS (SELECT 1 FROM payer p WHERE p.payer_id = cu.payer_id)"),
    "DQ-10": _exception(
        "DQ-10", "cu", "billed_amount",
        f"CASE WHEN provider_npi IS NULL THEN 'provider_npi is blank' WHEN NOT {_NPI_SHAPE} THEN "
        "concat('provider_npi \"', provider_npi, '\" is not 10 numeric digits') ELSE "
        "concat('provider_npi ', provider_npi, ' fails the Luhn check digit') END",
        f"provider_npi IS NULL OR CASE WHEN {_NPI_SHAPE} THEN (24 + {_LUHN}) % 10 <> 0 "
        "ELSE true END"),
    "DQ-11": _exception(
        "DQ-11", f"""(SELECT *, concat_ws('; ',
            CASE WHEN EXISTS (SELECT 1 FROM tr WHERE tr.claim_id = cu.claim_id
                AND tr.remit_date < cu.date_of_service)
                THEN 'remittance dated before the date of service' END,
            CASE WHEN claim_submit_date < date_of_service THEN concat('claim submitted ',
                claim_submit_date, ', before the date of service ', date_of_service) END,
            CASE WHEN date_of_service > DATE '{AUDIT_DATE}' THEN concat('date of service ',
                date_of_service, ' is in the future (audit date ', DATE '{AUDIT_DATE}', ')') END)
            AS issues FROM cu) f""", "0", "issues", "issues <> ''"),
    "DQ-12": _exception(
        "DQ-12", """(SELECT *, concat_ws('; ',
            CASE WHEN patient_id IS NULL THEN 'patient_id blank' END,
            CASE WHEN date_of_service IS NULL THEN 'date_of_service blank or unparseable' END,
            CASE WHEN cpt_code IS NULL THEN 'cpt_code blank'
                 WHEN NOT regexp_full_match(trim(cpt_code_raw), '[0-9]{4}[0-9A-Z]')
                 THEN concat('cpt_code "', trim(cpt_code_raw), '" is malformed') END,
            CASE WHEN icd10_code IS NULL THEN 'icd10_code blank'
                 WHEN NOT regexp_full_match(trim(icd10_code_raw),
                     '[A-TV-Z][0-9][0-9A-Z]([.][0-9A-Z]{1,4})?')
                 THEN concat('icd10_code "', trim(icd10_code_raw), '" is malformed') END,
            CASE WHEN billed_amount IS NULL THEN 'billed_amount blank or unparseable'
                 WHEN billed_amount <= 0 THEN concat('billed_amount is ', billed_amount) END)
            AS issues FROM cu) f""", "coalesce(billed_amount, 0)", "issues", "issues <> ''"),
}

QUERY_NAMES = {row[0]: "dq" + row[5][3:] for row in schemas.ROUTING}

EXCEPTIONS = {"exc": " UNION ALL ".join(CHECKS.values())}
_ALL_TEXT = ", ".join(f"coalesce(CAST(exc.{c} AS VARCHAR), '<null>')"
                      for c in schemas.EXCEPTION_COLUMNS)
REGISTER = {
    "reg": f"""SELECT sha256(concat_ws(chr(31), '{RUN_ID}', {_ALL_TEXT}, copy)) AS exception_id,
        '{RUN_ID}' AS run_id, TIMESTAMP '{RUN_TS}' AS run_ts, exc.* EXCLUDE (copy),
        q.assigned_queue,
        'OPEN' AS disposition, CAST(NULL AS VARCHAR) AS disposition_reason,
        CAST(NULL AS TIMESTAMP) AS resolved_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(schemas.EXCEPTION_COLUMNS)})
            AS copy FROM exc) exc LEFT JOIN routing q ON q.check_id = exc.check_id""",
}

_IMPACT = _total("sum(abs(amount_impact))")
SUMMARY = {
    "summary": f"""SELECT c.check_id, check_name, dimension, severity,
        coalesce(n, 0) AS exceptions_found, coalesce(claims, 0) AS claims_affected,
        {_total('coalesce(impact, 0)')} AS financial_impact_usd,
        {_pct('coalesce(n, 0)', '(SELECT count(*) FROM cu)', '100.0', 3)} AS exception_rate_pct,
        CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS result, failure_condition, escalation
        FROM catalog c LEFT JOIN (SELECT check_id, count(*) AS n,
            count(DISTINCT claim_id) AS claims, {_IMPACT} AS impact FROM reg GROUP BY check_id) x
        ON x.check_id = c.check_id""",
}
VALIDATION = {
    "scores": """SELECT c.check_id, check_name,
        (SELECT count(*) FROM ledger l WHERE l.check_id = c.check_id) AS injected,
        (SELECT count(DISTINCT entity_key) FROM reg r WHERE r.check_id = c.check_id) AS detected,
        (SELECT count(*) FROM (SELECT DISTINCT check_id, entity_key FROM ledger) l
            WHERE l.check_id = c.check_id AND (l.check_id, l.entity_key) IN
                (SELECT (check_id, entity_key) FROM reg)) AS hits FROM catalog c""",
    "validation": f"""SELECT check_id, check_name, injected AS injected_defects,
        detected AS detected_exceptions, hits AS true_positives,
        injected - hits AS false_negatives, detected - hits AS false_positives,
        {_pct('hits', 'injected', '100.0', 1)} AS recall_pct,
        {_pct('hits', 'detected', '100.0', 1)} AS precision_pct,
        CASE WHEN injected = hits AND detected = hits THEN 'PASS' ELSE 'REVIEW' END AS suite_result
        FROM scores""",
}
CROSSFOOT = {
    "verdicts": f"""SELECT claim_id, claim_status, billed_amount, remit_line_count, paid_total,
        {_total('coalesce(paid_total, 0) + coalesce(patient_resp_total, 0) + coalesce(adjustment_total, 0)')}
            AS recomputed_accounted,
        {_total('coalesce(billed_amount, 0) - (coalesce(paid_total, 0) + coalesce(patient_resp_total, 0) + coalesce(adjustment_total, 0))')}
            AS recomputed_variance,
        CASE WHEN coalesce(billed_amount, 0) <= 0 THEN 'INVALID CHARGE'
             WHEN remit_line_count = 0 THEN CASE WHEN claim_status = 'PAID'
                 THEN 'NO REMITTANCE (PAID)' ELSE 'NO REMITTANCE' END
             WHEN remit_line_count > 1 THEN 'DUPLICATE POSTING'
             WHEN coalesce(paid_total, 0) > billed_amount THEN 'OVERPAYMENT'
             WHEN abs(billed_amount - coalesce(paid_total, 0) - coalesce(patient_resp_total, 0)
                 - coalesce(adjustment_total, 0)) > 0.01 THEN 'MISMATCH'
             ELSE 'BALANCED' END AS verdict FROM rc""",
    "detail": """SELECT v.*, held.register_check,
        CASE WHEN (verdict, coalesce(register_check, '')) IN (('BALANCED', ''),
            ('INVALID CHARGE', ''), ('NO REMITTANCE', ''), ('DUPLICATE POSTING', ''),
            ('NO REMITTANCE (PAID)', 'DQ-05'), ('MISMATCH', 'DQ-06'), ('OVERPAYMENT', 'DQ-07'))
            THEN 'AGREE' ELSE 'CHECK' END AS agreement
        FROM verdicts v LEFT JOIN (SELECT claim_id, min(check_id) AS register_check FROM reg
            WHERE check_id IN ('DQ-05', 'DQ-06', 'DQ-07') GROUP BY claim_id) held
        ON held.claim_id = v.claim_id""",
}
# The day an item is due, found by walking the calendar.
SLA = {
    "weekday": f"""SELECT d, row_number() OVER (ORDER BY d) AS n FROM (
        SELECT CAST(unnest(generate_series(DATE '{RUN_TS[:10]}' + 1, DATE '{RUN_TS[:10]}' + 20,
            INTERVAL 1 DAY)) AS DATE) AS d) t WHERE isodow(d) < 6""",
    "due": f"""SELECT check_id, CASE WHEN sla_business_days = 0
        THEN TIMESTAMP '{RUN_TS}' + INTERVAL 24 HOUR ELSE CAST(d + 1 AS TIMESTAMP) END AS due_ts
        FROM routing LEFT JOIN weekday ON n = sla_business_days""",
}


def _chain(final: str, *groups: dict[str, str]) -> str:
    steps = {name: body for group in groups for name, body in group.items()}
    named = ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in steps.items())
    return f"WITH {named} {final}"


_TYPED = (MASTER, feeds(), TYPED)
_RECON = (*_TYPED, RECON)
_REGISTER = (*_RECON, EXCEPTIONS, REGISTER)
_CLEAN = (MASTER, feeds(defects=False), TYPED, RECON, EXCEPTIONS)

_CONTROL = """SELECT c.check_id, count(exc.check_id) AS false_positives,
    CASE WHEN count(exc.check_id) = 0 THEN 'PASS' ELSE 'FAIL' END AS result
    FROM catalog c LEFT JOIN exc ON exc.check_id = c.check_id GROUP BY c.check_id"""

_ZERO = _total("0")
_EXPOSURE = _total("coalesce(sum(abs(amount_impact)), 0)")

# The runs of the repeat-defect query: the fourth night is clean, and in the second the
# remittance feed came late, so only claims were audited.
RUNS = [(f"RUN-0{i}", f"2001-12-{24 + i} 06:00:00") for i in range(1, 8)]
CLAIM_RUNS = ["RUN-01", "RUN-02", "RUN-03", "RUN-05", "RUN-06", "RUN-07"]
REMIT_RUNS = ["RUN-01", "RUN-03", "RUN-05", "RUN-06", "RUN-07"]

# How the disposition query treats the items of each check.
# Columns are check_id, disposition, disposition_reason, resolved.
DISPOSITIONS = [
    ("DQ-01", "RESOLVED", "resend collapsed", True),
    ("DQ-02", "RESOLVED", "confirmed by charge entry", False),
    ("DQ-03", "WAIVED", " ", False),
    ("DQ-04", "CARRIED FORWARD", "payer queried", False),
    ("DQ-05", "DONE", "status corrected", True),
]
_STATE = "CASE check_id " + " ".join(
    f"WHEN '{c}' THEN '{d}'" for c, d, _, _ in DISPOSITIONS) + " ELSE 'OPEN' END"
_REASON = "CASE check_id " + " ".join(
    f"WHEN '{c}' THEN '{w}'" for c, _, w, _ in DISPOSITIONS) + " END"

TRIAGE_N = 25

_BUCKETS = "(SELECT *, k % 100 AS b FROM o WHERE k % 100 < 12) z"
_PLANTED_KEY = """CASE b WHEN 1 THEN 'RB-' || cid WHEN 2 THEN 'RP-RMT-' || k
    WHEN 3 THEN 'GH-RMT-' || k ELSE cid END"""
_PLANTED_NOTE = """CASE b WHEN 0 THEN 'Exact claim_id re-submitted under a resend batch'
    WHEN 1 THEN 'Duplicate billing fingerprint of ' || cid || ' under a new claim id'
    WHEN 2 THEN 'Second posting of claim ' || cid || ' under the same check/EFT'
    WHEN 3 THEN 'Remittance posted against a claim absent from the claims feed'
    WHEN 4 THEN 'Claim carries PAID status but no remittance line was received'
    WHEN 5 THEN 'Payments no longer balance to the billed amount on claim ' || cid
    WHEN 6 THEN 'Paid amount exceeds the billed charge on claim ' || cid
    WHEN 7 THEN 'Allowed amount is more than 10% below the contracted expectation on claim ' || cid
    WHEN 8 THEN 'Payer id is blank or absent from the payer master'
    WHEN 9 THEN 'Provider NPI fails the 10-digit Luhn standard'
    WHEN 10 THEN 'Temporal integrity break' ELSE 'Mandatory field blank or malformed' END"""


# How many defects of each check the exact plan plants.
EXACT_PLAN = dict(zip(CHECKS, [90, 140, 75, 120, 60, 310, 45, 200, 55, 70, 85, 130], strict=True))


def _exact_steps() -> dict[str, str]:
    """Each defect takes the first claims that it fits, by a hash, of those that are left."""
    fits = {"DQ-03": "paid", "DQ-04": "paid", "DQ-05": "paid", "DQ-07": "paid",
            "DQ-06": "paid AND (billed - expected > 3 OR expected > 2.5)",
            "DQ-08": "paid AND expected > 1"}
    steps = {"left0": """SELECT *, status = 'PAID' AS paid, status AS claim_status,
        status <> 'PENDING' AS has_line, CAST('0x' || substr(md5(cid), 1, 15) AS BIGINT) AS u FROM o"""}
    for i, (check_id, n) in enumerate(EXACT_PLAN.items()):
        steps[f"take{i}"] = (f"SELECT *, '{check_id}' AS check_id FROM left{i} WHERE "
                             f"{fits.get(check_id, 'true')} ORDER BY u LIMIT {n}")
        steps[f"left{i + 1}"] = f"SELECT * FROM left{i} WHERE k NOT IN (SELECT k FROM take{i})"
    return steps


def _oracles() -> dict[str, str]:
    receipts = """SELECT 'claims_source' AS table_name, count(*) AS rows_loaded,
            0::BIGINT AS rows_rejected FROM claims
        UNION ALL SELECT 'payments_remittance', count(*), 0 FROM remits
        UNION ALL SELECT 'payer_reference', count(*), 0 FROM payer
        UNION ALL SELECT 'cpt_reference', 16, 0"""
    out = {
        "load_receipt": _chain(receipts, MASTER, feeds()),
        "entry_criteria": _chain(
            f"""SELECT table_name, rows_loaded, rows_rejected,
                CAST(CASE table_name WHEN 'payer_reference' THEN 9 WHEN 'cpt_reference' THEN 17 END
                    AS BIGINT) AS rows_received,
                CASE WHEN rows_loaded = 0 THEN 'EMPTY' WHEN table_name = 'cpt_reference'
                    THEN 'SHORT' ELSE 'MET' END AS criterion FROM ({receipts}) t""",
            MASTER, feeds()),
        "reference_violations": _chain(
            """SELECT 'claims' AS table_name, 'UNIQUE' AS rule, 'claim_id' AS column_name,
                claim_id AS key_value, count(*) AS rows FROM tc GROUP BY claim_id
                HAVING count(*) > 1
            UNION ALL SELECT 'claims', 'NOT NULL', 'patient_id', claim_id, count(*) FROM tc
                WHERE patient_id IS NULL GROUP BY claim_id
            UNION ALL SELECT 'claims', 'NOT NULL', 'date_of_service', claim_id, count(*) FROM tc
                WHERE date_of_service IS NULL GROUP BY claim_id
            UNION ALL SELECT 'claims', 'FOREIGN KEY', 'payer_id', tc.payer_id, count(*) FROM tc
                LEFT JOIN payer p ON p.payer_id = tc.payer_id
                WHERE p.payer_id IS NULL AND tc.payer_id IS NOT NULL GROUP BY tc.payer_id""",
            *_TYPED),
        "typed_claims": _chain("SELECT * FROM tc", *_TYPED),
        "typed_remits": _chain("SELECT * FROM tr", *_TYPED),
        "claim_unique": _chain("SELECT * FROM cu", *_RECON),
        "remit_by_claim": _chain("SELECT * FROM rb", *_RECON),
        "claim_recon": _chain("SELECT * FROM rc", *_RECON),
    }
    for check_id, body in CHECKS.items():
        out[QUERY_NAMES[check_id]] = _chain(body, *_RECON)
    out["all_exceptions"] = _chain("SELECT * FROM exc", *_RECON, EXCEPTIONS)
    out["all_exceptions_fused"] = out["all_exceptions"]
    out["exception_register"] = _chain("SELECT * FROM reg", *_REGISTER)
    out["stored_run"] = _chain(f"SELECT * REPLACE ('{ODD_RUN}' AS run_id) FROM reg", *_REGISTER)
    out["export_register"] = _chain(
        f"SELECT {', '.join(schemas.REGISTER_EXPORT_COLUMNS)}, "
        "abs(amount_impact) AS absolute_impact FROM reg", *_REGISTER)
    out["export_recon"] = _chain(
        f"SELECT {', '.join(schemas.RECON_EXPORT_COLUMNS)} FROM rc", *_RECON)
    out["export_exceptions"] = _chain(
        f"SELECT {', '.join(schemas.EXCEPTION_COLUMNS)} FROM exc", *_RECON, EXCEPTIONS)
    out["csv_claims"] = _chain(
        """SELECT * REPLACE (payer_name || ', "Inc" ' AS payer_name) FROM claims""",
        MASTER, feeds())
    out["csv_payers"] = _chain(
        """SELECT payer_id, payer_name, payer_type, CAST(contract_rate AS DECIMAL(5,2)) AS contract_rate,
            (SELECT count(*) FROM claims c WHERE c.payer_id = payer.payer_id) AS claims FROM payer""",
        MASTER, feeds())
    out["csv_cpt"] = _chain(
        """SELECT cpt_code, cpt_description, CAST(standard_charge AS DECIMAL(12,2)) AS standard_charge,
            (SELECT count(*) FROM claims c WHERE c.cpt_code = cpt.cpt_code) AS claims FROM cpt""",
        {"cpt": _values(CPT_ROWS, "cpt_code, cpt_description, standard_charge")}, feeds())
    out["remit_violations"] = _chain(
        """SELECT 'remits' AS table_name, 'UNIQUE' AS rule, 'remit_id' AS column_name,
            coalesce(remit_id, '<null>') AS key_value, count(*) AS rows FROM tr GROUP BY remit_id
            HAVING count(*) > 1
        UNION ALL SELECT 'remits', 'NOT NULL', c, coalesce(remit_id, '<null>'), count(*) FROM (
            SELECT remit_id, unnest(['remit_id', 'claim_id', 'paid_amount']) AS c,
                unnest([remit_id IS NULL, claim_id IS NULL, paid_amount IS NULL]) AS missing FROM tr) t
            WHERE missing GROUP BY c, remit_id
        UNION ALL SELECT 'remits', 'FOREIGN KEY', 'claim_id', claim_id, count(*) FROM tr
            WHERE claim_id IS NOT NULL AND claim_id NOT IN (
                SELECT claim_id FROM tc WHERE claim_id IS NOT NULL) GROUP BY claim_id""", *_TYPED)
    out["register_violations"] = _chain(
        """SELECT 'register' AS table_name, 'UNIQUE' AS rule, 'exception_id' AS column_name,
            exception_id AS key_value, 2::BIGINT AS rows FROM reg WHERE check_id = 'DQ-01'
        UNION ALL SELECT 'register', 'NOT NULL', 'claim_id', exception_id,
            CASE check_id WHEN 'DQ-01' THEN 2 ELSE 1 END FROM reg WHERE claim_id IS NULL
        UNION ALL SELECT 'register', 'FOREIGN KEY', 'check_id', check_id, count(*) FROM reg
            WHERE check_id = 'DQ-02' GROUP BY check_id""", *_REGISTER)
    out["guarded_register"] = _chain("SELECT * FROM reg", *_REGISTER)
    out["laid_out_register"] = out["exception_register"]
    out["export_reports"] = _chain("SELECT * FROM summary", *_REGISTER, SUMMARY)
    out["export_order"] = _chain(
        """SELECT 'exception_register' AS export, '' AS folder, count(*) AS rows,
            min(check_id || '|' || entity_key) AS first_key,
            max(check_id || '|' || entity_key) AS last_key,
            CAST(sum(coalesce(abs(amount_impact), 0)) AS DECIMAL(38,2)) AS amount, 0::BIGINT AS overlaps
            FROM reg
        UNION ALL SELECT 'claim_reconciliation', '', count(*), min(claim_id), max(claim_id),
            CAST(sum(coalesce(billed_amount, 0)) AS DECIMAL(38,2)), 0 FROM rc
        UNION ALL SELECT 'exceptions', 'evidence=' || evidence, count(*),
            min(evidence || '|' || entity_key), max(evidence || '|' || entity_key),
            CAST(sum(coalesce(amount_impact, 0)) AS DECIMAL(38,2)), 0
            FROM reg JOIN routing USING (check_id) GROUP BY evidence""", *_REGISTER)
    out["csv_remits"] = _chain("SELECT * FROM remits", MASTER, feeds())
    out["dq_summary"] = _chain("SELECT * FROM summary", *_REGISTER, SUMMARY)
    out["control_totals"] = _chain(
        f"""SELECT count(*) AS claims_in_scope,
            sum(CAST(remit_line_count > 0 AS BIGINT))::BIGINT AS claims_with_remittance,
            sum(CAST(remit_line_count = 0 AS BIGINT))::BIGINT AS claims_without_remittance,
            {_total('sum(coalesce(billed_amount, 0))')} AS billed_total,
            {_total('sum(coalesce(allowed_total, 0))')} AS allowed_total,
            {_total('sum(coalesce(paid_total, 0))')} AS paid_total,
            {_total('sum(coalesce(patient_resp_total, 0))')} AS patient_responsibility_total,
            {_total('sum(coalesce(adjustment_total, 0))')} AS adjustment_total,
            {_total('sum(coalesce(billed_amount, 0)) - sum(coalesce(paid_total, 0)) - sum(coalesce(patient_resp_total, 0)) - sum(coalesce(adjustment_total, 0))')}
                AS unreconciled_variance,
            {_total('sum(CASE WHEN remit_line_count > 0 THEN coalesce(billed_amount, 0) END)')}
                AS billed_total_adjudicated,
            {_total('sum(CASE WHEN remit_line_count > 0 THEN balance_variance END)')}
                AS variance_adjudicated,
            {_total('sum(CASE WHEN remit_line_count > 0 THEN abs(balance_variance) END)')}
                AS abs_variance_adjudicated FROM rc""", *_RECON)
    out["payer_scorecard"] = _chain(
        f"""SELECT b.payer_id, coalesce(p.payer_name, 'Unmapped / unknown payer') AS payer_name,
            claims, billed_total, coalesce(n, 0) AS exceptions,
            {_total('coalesce(impact, 0)')} AS financial_impact_usd,
            {_pct('coalesce(n, 0)', 'claims', '1000.0', 1)} AS exceptions_per_1000_claims
            FROM (SELECT coalesce(payer_id, 'UNMAPPED') AS payer_id, count(*) AS claims,
                {_total('sum(coalesce(billed_amount, 0))')} AS billed_total FROM cu GROUP BY 1) b
            LEFT JOIN (SELECT coalesce(payer_id, 'UNMAPPED') AS payer_id, count(*) AS n,
                {_IMPACT} AS impact FROM reg GROUP BY 1) e ON e.payer_id = b.payer_id
            LEFT JOIN payer p ON p.payer_id = b.payer_id""", *_REGISTER)
    out["suite_validation"] = _chain("SELECT * FROM validation", *_REGISTER, LEDGER, VALIDATION)
    out["negative_control"] = _chain(_CONTROL, *_CLEAN)
    out["recon_verdict"] = _chain("SELECT * FROM verdicts", *_RECON, CROSSFOOT | {
        "detail": "SELECT 1"})
    out["crossfoot_detail"] = _chain("SELECT * FROM detail", *_REGISTER, CROSSFOOT)
    out["crossfoot_from_exports"] = out["crossfoot_detail"]
    out["crossfoot_summary"] = _chain(
        """SELECT check_id, tests, register_count, recomputed_count,
            CASE WHEN check_id = 'ALL' THEN disagreements ELSE register_count - recomputed_count END
                AS difference,
            CASE WHEN CASE WHEN check_id = 'ALL' THEN disagreements
                ELSE register_count - recomputed_count END = 0 THEN 'AGREE' ELSE 'INVESTIGATE' END
                AS status FROM (
            SELECT t.check_id, t.tests,
                (SELECT count(*) FROM reg WHERE reg.check_id = t.check_id) AS register_count,
                (SELECT count(*) FROM detail WHERE detail.verdict = t.verdict) AS recomputed_count,
                NULL AS disagreements
            FROM (VALUES ('DQ-05', 'NO REMITTANCE (PAID)', 'Claim marked PAID, no remittance line'),
                ('DQ-06', 'MISMATCH', 'Billed ≠ paid + patient resp + adjustment'),
                ('DQ-07', 'OVERPAYMENT', 'Paid exceeds the billed charge')) t(check_id, verdict, tests)
            UNION ALL SELECT 'ALL', 'Recomputed verdict vs register, every claim', count(*),
                count(CASE WHEN agreement = 'AGREE' THEN 1 END),
                count(CASE WHEN agreement = 'CHECK' THEN 1 END) FROM detail) u""",
        *_REGISTER, CROSSFOOT)
    out["check_summary"] = _chain(
        f"""SELECT s.check_id, check_name, dimension, severity, q.assigned_queue,
            exceptions_found AS exceptions, financial_impact_usd AS financial_exposure_usd,
            exception_rate_pct, result, failure_condition, escalation
            FROM summary s JOIN routing q ON q.check_id = s.check_id
            UNION ALL SELECT NULL, NULL, NULL, NULL, 'TOTAL', sum(exceptions_found)::BIGINT,
            {_total('sum(financial_impact_usd)')}, NULL, NULL, NULL, NULL FROM summary""",
        *_REGISTER, SUMMARY)
    out["defect_log"] = _chain(
        f"""SELECT 'DEF-' || lpad(CAST(row_number() OVER (ORDER BY c.check_id) AS VARCHAR), 3, '0')
                AS defect_id, DATE '{AUDIT_DATE}' AS raised, c.check_id,
            check_name AS defect_title, severity, root_cause,
            (SELECT count(*) FROM reg WHERE reg.check_id = c.check_id) AS volume,
            (SELECT {_EXPOSURE} FROM reg WHERE reg.check_id = c.check_id)
                AS financial_exposure_usd, q.assigned_queue, sla_label AS target_sla,
            'OPEN' AS status, 'output/exceptions/evidence=' || evidence AS evidence_file
            FROM catalog c JOIN routing q ON q.check_id = c.check_id""", *_REGISTER)
    out["severity_mix"] = _chain(
        f"""SELECT s.severity, count(reg.severity) AS exceptions,
            {_pct('count(reg.severity)', '(SELECT count(*) FROM reg)', '100.0', 1)} AS share_pct,
            {_EXPOSURE} AS financial_exposure_usd
            FROM (SELECT DISTINCT severity FROM catalog) s
            LEFT JOIN reg ON reg.severity = s.severity GROUP BY s.severity
            UNION ALL SELECT 'TOTAL', count(*), 100.0, {_EXPOSURE} FROM reg""", *_REGISTER)
    out["payer_scorecard_total"] = _chain(
        f"""SELECT payer_id, payer_name, claims, billed_total, exceptions, financial_exposure_usd,
            {_pct('exceptions', 'claims', '1000.0', 1)} AS exceptions_per_1000_claims FROM (
            SELECT coalesce(ids.payer_id, 'UNMAPPED') AS payer_id,
                coalesce(p.payer_name, 'Unmapped / unknown payer') AS payer_name,
                (SELECT count(*) FROM rc WHERE rc.payer_id IS NOT DISTINCT FROM ids.payer_id)
                    AS claims,
                (SELECT {_total('coalesce(sum(billed_amount), 0)')} FROM rc
                    WHERE rc.payer_id IS NOT DISTINCT FROM ids.payer_id) AS billed_total,
                (SELECT count(*) FROM reg WHERE reg.payer_id IS NOT DISTINCT FROM ids.payer_id)
                    AS exceptions,
                (SELECT {_EXPOSURE} FROM reg
                    WHERE reg.payer_id IS NOT DISTINCT FROM ids.payer_id)
                    AS financial_exposure_usd
            FROM (SELECT payer_id FROM rc UNION SELECT payer_id FROM reg) ids
            LEFT JOIN payer p ON p.payer_id = ids.payer_id) x
            UNION ALL SELECT NULL, 'TOTAL', (SELECT count(*) FROM rc),
                (SELECT {_total('sum(billed_amount)')} FROM rc), count(*), {_EXPOSURE}, NULL
            FROM reg""", *_REGISTER)
    out["headline"] = _chain(
        f"""SELECT (SELECT count(*) FROM cu) AS unique_claims,
            (SELECT count(*) FROM claims) + (SELECT count(*) FROM remits) AS rows_compared,
            count(*) AS exceptions,
            {_pct('count(*)', '(SELECT count(*) FROM cu)', '100.0', 1)} AS exception_rate_pct,
            count(CASE WHEN severity = 'CRITICAL' THEN 1 END) AS critical_exceptions,
            {_EXPOSURE} AS financial_exposure_usd,
            (SELECT {_total('sum(billed_amount)')} FROM rc) AS billed_in_scope,
            (SELECT {_total('sum(balance_variance)')} FROM rc WHERE remit_line_count > 0)
                AS net_variance_adjudicated FROM reg""", *_REGISTER)
    out["book_cells"] = _chain(
        f"""SELECT rc.payer_id, v.verdict, count(*) AS claims_in_scope,
            count(CASE WHEN rc.remit_line_count > 0 THEN 1 END) AS claims_with_remittance,
            count(CASE WHEN rc.remit_line_count = 0 THEN 1 END) AS claims_without_remittance,
            sum(n)::BIGINT AS claim_rows,
            {_total('sum(coalesce(rc.billed_amount, 0))')} AS billed_total,
            {_total('sum(coalesce(allowed_total, 0))')} AS allowed_total,
            {_total('sum(coalesce(rc.paid_total, 0))')} AS paid_total,
            {_total('sum(coalesce(patient_resp_total, 0))')} AS patient_responsibility_total,
            {_total('sum(coalesce(adjustment_total, 0))')} AS adjustment_total,
            {_total('sum(recomputed_variance)')} AS unreconciled_variance,
            {_total('sum(CASE WHEN rc.remit_line_count > 0 THEN coalesce(rc.billed_amount, 0) END)')}
                AS billed_total_adjudicated,
            {_total('sum(CASE WHEN rc.remit_line_count > 0 THEN balance_variance END)')}
                AS variance_adjudicated,
            {_total('sum(CASE WHEN rc.remit_line_count > 0 THEN abs(balance_variance) END)')}
                AS abs_variance_adjudicated
            FROM rc JOIN verdicts v ON v.claim_id = rc.claim_id
            JOIN (SELECT trim(claim_id) AS claim_id, count(*) AS n FROM claims GROUP BY 1) r
                ON r.claim_id = rc.claim_id GROUP BY rc.payer_id, v.verdict""",
        *_RECON, CROSSFOOT | {"detail": "SELECT 1"})
    out["finding_cells"] = _chain(
        f"""SELECT false AS of_check, check_id, severity, payer_id, CAST(NULL AS BIGINT) AS claims,
            count(*) AS found, {_IMPACT} AS impact FROM reg GROUP BY check_id, severity, payer_id
            UNION ALL SELECT true, check_id, NULL, NULL, count(DISTINCT claim_id), NULL, NULL
            FROM reg GROUP BY check_id""", *_REGISTER)
    out["run_verdict"] = _chain(
        f"""SELECT claims, exceptions, critical_exceptions,
            {_pct('exceptions', 'claims', '100.0', 3)} AS exception_rate_pct,
            CASE WHEN critical_exceptions = 0 AND exceptions < 0.005 * claims THEN 'PASS'
                 ELSE 'FAIL' END AS verdict
            FROM (SELECT (SELECT count(*) FROM cu) AS claims, count(*) AS exceptions,
                count(CASE WHEN severity = 'CRITICAL' THEN 1 END) AS critical_exceptions
                FROM reg) t""", *_REGISTER)
    clean_count = _chain("SELECT count(*) AS n FROM exc", *_CLEAN)
    out["suite_verdict"] = _chain(
        f"""SELECT *, CASE WHEN false_negatives + false_positives + clean_findings = 0 THEN 'PASS'
                ELSE 'FAIL' END AS verdict FROM (
            SELECT sum(injected_defects)::BIGINT AS injected,
                sum(false_negatives)::BIGINT AS false_negatives,
                sum(false_positives)::BIGINT AS false_positives,
                (SELECT n FROM ({clean_count}) c) AS clean_findings FROM validation) t""",
        *_REGISTER, LEDGER, VALIDATION)
    out["class_rollup"] = _chain(
        f"""SELECT q.finding_class,
            string_agg(DISTINCT q.check_id, ', ' ORDER BY q.check_id) AS checks,
            count(reg.check_id) AS volume, {_EXPOSURE} AS exposure_usd
            FROM routing q LEFT JOIN reg ON reg.check_id = q.check_id GROUP BY q.finding_class
            UNION ALL SELECT 'TOTAL', NULL, count(*), {_EXPOSURE} FROM reg""", *_REGISTER)
    out["triage_queue"] = _chain(
        f"""SELECT assigned_queue, severity, check_id, entity_key, claim_id, amount_impact,
            finding, row_number() OVER (PARTITION BY assigned_queue ORDER BY
                CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END,
                abs(amount_impact) DESC NULLS LAST, check_id, entity_key, finding) AS queue_rank
            FROM reg QUALIFY queue_rank <= {TRIAGE_N}""", *_REGISTER)
    out["sla_ageing"] = _chain(
        f"""SELECT reg.check_id, severity, entity_key, assigned_queue, disposition, run_ts,
            due_ts, CASE WHEN TIMESTAMP '{AS_OF}' > due_ts THEN 'BREACHED' ELSE 'IN TIME' END
                AS sla_status, finding FROM reg JOIN due ON due.check_id = reg.check_id""",
        *_REGISTER, SLA)
    out["escalations"] = _chain(
        f"""SELECT check_id, 'claim' AS scope, entity_key AS scope_key, 1 AS items,
            {_total('abs(amount_impact)')} AS exposure_usd, 'Payer Relations' AS escalate_to
            FROM reg WHERE check_id = 'DQ-06' AND abs(amount_impact) > 500
            UNION ALL SELECT 'DQ-05', 'run', run_id, count(*), {_EXPOSURE}, 'A/R manager'
            FROM reg WHERE check_id = 'DQ-05' GROUP BY run_id
            HAVING count(*) >= 10 OR sum(abs(amount_impact)) >= 5000
            UNION ALL SELECT 'DQ-08', 'payer', coalesce(payer_id, 'UNMAPPED'), count(*),
            {_EXPOSURE}, 'Payer Relations' FROM reg WHERE check_id = 'DQ-08'
            GROUP BY coalesce(payer_id, 'UNMAPPED')
            HAVING count(*) >= 25 OR sum(abs(amount_impact)) >= 5000""", *_REGISTER)
    seen = " UNION ALL ".join(
        f"SELECT check_id, {i + 1} AS run_no, '{run}' AS run, count(*) AS n FROM reg WHERE "
        + ("true" if run in REMIT_RUNS else "entity_type = 'claim'") + " GROUP BY check_id"
        for i, (run, _) in enumerate(RUNS) if run in CLAIM_RUNS)
    out["repeat_defects"] = _chain(
        f"""SELECT check_id, count(*) AS consecutive_runs, min(run) AS first_run,
            max(run) AS last_run, sum(n)::BIGINT AS exceptions FROM (
            SELECT *, run_no - dense_rank() OVER (PARTITION BY check_id ORDER BY run_no) AS island
            FROM ({seen}) s) t GROUP BY check_id, island HAVING count(*) >= 3""", *_REGISTER)
    out["unmatched_payments"] = _chain(
        f"""SELECT check_id, run_id, 'payment' AS scope, entity_key AS scope_key, count(*) AS items,
            {_EXPOSURE} AS exposure_usd, 'Payer' AS escalate_to FROM reg
            WHERE check_id = 'DQ-04' AND TIMESTAMP '{AS_OF}' >
                (SELECT CAST(d + 1 AS TIMESTAMP) FROM weekday WHERE n = 2)
            GROUP BY check_id, run_id, entity_key""", *_REGISTER, SLA)
    nights = ", ".join(f"({i + 1}, '{run}')" for i, (run, _) in enumerate(RUNS) if run in CLAIM_RUNS)
    out["repeating_feeds"] = _chain(
        f"""SELECT 'DQ-11' AS check_id, 'feed' AS scope, scope_key, min_by(run, run_no) AS first_run,
            max_by(run, run_no) AS last_run, count(*) AS consecutive_runs, sum(n)::BIGINT AS items,
            'Interface team' AS escalate_to FROM (
            SELECT *, run_no - row_number() OVER (PARTITION BY scope_key ORDER BY run_no) AS island
            FROM (SELECT coalesce(cu.source_system, 'UNKNOWN') AS scope_key, run_no, run,
                    count(*) AS n FROM reg JOIN cu ON cu.claim_id = reg.claim_id,
                    (VALUES {nights}) AS r(run_no, run) WHERE check_id = 'DQ-11'
                    GROUP BY 1, 2, 3) s) t
            GROUP BY scope_key, island HAVING count(*) >= 2""", *_REGISTER)
    out["disposition_violations"] = _chain(
        f"""SELECT run_id, reg.check_id, entity_key, assigned_queue, {_STATE.replace('check_id', 'reg.check_id')} AS disposition,
            {_REASON.replace('check_id', 'reg.check_id')} AS disposition_reason,
            CASE reg.check_id WHEN 'DQ-02' THEN 'resolved without a time'
                WHEN 'DQ-03' THEN 'closed without a reason'
                WHEN 'DQ-05' THEN 'unknown disposition' ELSE 'open past its SLA' END AS violation,
            finding FROM reg JOIN due ON due.check_id = reg.check_id
            WHERE reg.check_id IN ('DQ-02', 'DQ-03', 'DQ-05')
                OR (reg.check_id NOT IN ('DQ-01', 'DQ-04')
                    AND TIMESTAMP '{AS_OF}' > due_ts)""", *_REGISTER, SLA)
    out["variance_profile"] = _chain(
        f"""SELECT {_total('sum(balance_variance)')} AS net_variance,
            {_total('sum(abs(balance_variance))')} AS absolute_variance,
            (SELECT count(*) FROM reg WHERE check_id = 'DQ-07') AS items,
            (SELECT {_total('max(abs(amount_impact))')} FROM reg WHERE check_id = 'DQ-07')
                AS largest_item,
            (SELECT {_total('round(median(abs(amount_impact)), 2)')} FROM reg
                WHERE check_id = 'DQ-07') AS median_item,
            (SELECT {_total('quantile_disc(abs(amount_impact), 0.9)')} FROM reg
                WHERE check_id = 'DQ-07') AS q90_item,
            (SELECT {_total('quantile_disc(abs(amount_impact), 0.99)')} FROM reg
                WHERE check_id = 'DQ-07') AS q99_item
            FROM rc WHERE remit_line_count > 0""".replace("DQ-07", "DQ-08"), *_REGISTER)
    out["planted_exact"] = _chain(
        "SELECT 'INJ-' || cid AS defect_ref, check_id, claim_status, has_line FROM ("
        + " UNION ALL ".join(f"SELECT * FROM take{i}" for i in range(len(EXACT_PLAN))) + ") t",
        {"o": feeds(False)["o"]}, _exact_steps())
    out["planted_ledger"] = _chain(
        f"""SELECT 'INJ-' || cid AS defect_ref, 'DQ-' || lpad(CAST(b + 1 AS VARCHAR), 2, '0')
            AS check_id, CASE WHEN b IN (2, 3) THEN 'remit' ELSE 'claim' END AS entity_type,
            {_PLANTED_KEY} AS entity_key, {_PLANTED_NOTE} AS description FROM {_BUCKETS}""",
        {"o": feeds(False)["o"]})
    out["csv_ledger"] = out["planted_ledger"]
    out["planted_validation"] = _chain(
        f"""SELECT c.check_id, check_name, n AS injected_defects, n AS detected_exceptions,
            n AS true_positives, 0::BIGINT AS false_negatives, 0::BIGINT AS false_positives,
            CAST(100.0 AS DECIMAL(18,1)) AS recall_pct, CAST(100.0 AS DECIMAL(18,1)) AS precision_pct,
            'PASS' AS suite_result FROM catalog c JOIN (SELECT 'DQ-' ||
                lpad(CAST(b + 1 AS VARCHAR), 2, '0') AS check_id, count(*) AS n
                FROM {_BUCKETS} GROUP BY b) x ON x.check_id = c.check_id""",
        MASTER, {"o": feeds(False)["o"]})
    return out


ORACLE = _oracles()
