"""Plant one known defect in a share of the claims of a clean book, and keep the ledger.

Every claim falls into one bucket; a bucket belongs to at most one defect, so no claim carries two.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.functions.scalars import sql_fill, sql_safe_date, sql_safe_numeric
from remitwise.operators.selection import ORDER_BITS, ROUND_BITS, Quota, deal_exactly
from remitwise.schemas import CLAIM_COLUMNS, MONEY, REMIT_COLUMNS
from remitwise.sources.scratch import scratch_path

# Default share of the book per defect: buckets out of 1,000.
BUCKETS = 1000
DEFAULT_PLAN = {
    "DQ-01": 4, "DQ-02": 6, "DQ-03": 3, "DQ-04": 5, "DQ-05": 3, "DQ-06": 12, "DQ-07": 2,
    "DQ-08": 8, "DQ-09": 2, "DQ-10": 3, "DQ-11": 3, "DQ-12": 5,
}

# The bad entries that stand for each defect.
BAD_PAYERS = ["PAY-XXX-999", "PAY-UNK-000", "", "PAY-BCB-03"]
BAD_CPT = ["", "9921", "ABCDE", "99213A"]
BAD_ICD10 = ["", "XX999", "E119"]
BAD_CHARGES = ["0.00", "-125.00"]

# Ledger wording per defect; `{}` is the claim_id.
NOTES = {
    "DQ-01": "Exact claim_id re-submitted under a resend batch",
    "DQ-02": "Duplicate billing fingerprint of {} under a new claim id",
    "DQ-03": "Second posting of claim {} under the same check/EFT",
    "DQ-04": "Remittance posted against a claim absent from the claims feed",
    "DQ-05": "Claim carries PAID status but no remittance line was received",
    "DQ-06": "Payments no longer balance to the billed amount on claim {}",
    "DQ-07": "Paid amount exceeds the billed charge on claim {}",
    "DQ-08": "Allowed amount is more than 10% below the contracted expectation on claim {}",
    "DQ-09": "Payer id is blank or absent from the payer master",
    "DQ-10": "Provider NPI fails the 10-digit Luhn standard",
    "DQ-11": "Temporal integrity break",
    "DQ-12": "Mandatory field blank or malformed",
}


def _cents(c: str) -> str:
    """Amount text as whole cents, so that all arithmetic is on integers."""
    return f"cast({sql_safe_numeric(c)} * 100 as bigint)"


def _amount(cents: str) -> str:
    return f"cast(cast(cast({cents} as decimal(18,0)) / 100 as {MONEY}) as string)"


def _pick(values: list[str], draw: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({draw} % {len(values)} as int) + 1)"


def _between(low: int, high: int) -> str:
    """A whole number of days in a range, by the draw."""
    return f"cast({low} + draw % {high - low + 1} as int)"


def _spot(plan: dict[str, int], bucket: str) -> str:
    """The defect of a bucket: the plan's shares laid end to end from bucket 0.

    A lookup works the bucket out once, the arms of a CASE would do so in each.
    """
    spots = ", ".join(f"'{check_id}'" for check_id, share in plan.items() for _ in range(share))
    return f"get(cast(array({spots}) as array<string>), {bucket})"


def plant_defects(claims: DataFrame, remits: DataFrame, audit_date: dt.date,
                  plan: dict[str, int] | None = None, seed: int = 0,
                  bucket: str | None = None, draw: str | None = None,
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dirty claims, dirty remittances and the ledger of what was planted.

    The inputs are clean landing tables: claim_id unique, at most one line per claim. `plan` gives
    the number of buckets per check. `bucket` and `draw` are SQL text over claim_id; by default the
    bucket is a hash of claim_id and `seed` out of 1,000, and the draw, which chooses the form of
    the defect, another hash. A defect of the payment side is planted on PAID claims with a line.

    Rows of a claim_id whose bucket has no defect pass by a filter. Only the others are joined; the
    claims among them are written once and serve all three results.
    """
    bucket = bucket or f"pmod(xxhash64(claim_id, {seed}), {BUCKETS})"
    draw = draw or f"xxhash64(claim_id, {seed}, 'draw')"

    def spotted(rows: DataFrame) -> DataFrame:
        return (rows.selectExpr("*", f"cast({bucket} as int) as bucket")
                .selectExpr("*", f"{_spot(plan or DEFAULT_PLAN, 'bucket')} as spot"))

    book, lines = spotted(claims), spotted(remits)
    marked = _store(_marks(book.filter("spot is not null"), lines.filter("spot is not null"), draw)
                    .selectExpr("*", f"case when {_fits('spot')} then spot end as defect")
                    .selectExpr("*", f"{FORM} as form"))
    return (_dirty_claims(marked, audit_date).unionByName(
                book.filter("spot is null").select(*CLAIM_COLUMNS)),
            _dirty_remits(marked, lines.filter("spot is not null")).unionByName(
                lines.filter("spot is null").select(*REMIT_COLUMNS)),
            _ledger(marked))


def plant_exactly(claims: DataFrame, remits: DataFrame, audit_date: dt.date, plan: dict[str, int],
                  seed: int = 0, order: str | None = None, draw: str | None = None,
                  strict: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dirty claims, dirty remittances and the ledger, with exactly so many defects of each check.

    Claims are taken in the order of `order`, SQL text over claim_id that gives distinct numbers below
    2**ORDER_BITS, by default a hash; each goes to the first defect of the plan that it can take and
    that has not its number yet. The book is not sorted: only its share with the smallest orders, as
    large as the plan needs, is joined to its lines and written, and ranks are found by counting
    (`deal_exactly`). The share does not change the outcome. Too small a book raises; with `strict`
    off it gets what it can take.
    """
    order = order or f"shiftrightunsigned(xxhash64(claim_id, {seed}, 'order'), {64 - ORDER_BITS})"
    draw = draw or f"xxhash64(claim_id, {seed}, 'draw')"
    book, lines = claims.selectExpr("*", f"{order} as u"), remits.selectExpr("*", f"{order} as u")
    step = 1 << (ORDER_BITS - ROUND_BITS)
    heads = sorted(map(tuple, book.groupBy(F.expr(f"u div {step} as head")).count().collect()))
    wanted = 4 * sum(plan.values())
    kind = " + ".join(f"if({_fits(repr(check_id))}, {1 << i}, 0)" for i, check_id in enumerate(plan)) or "0"
    while True:
        upto, seen = 0, 0
        for head, n in heads:
            if seen < wanted:
                upto, seen = (head + 1) * step, seen + n
        share = _store(_marks(book.filter(f"u < {upto}"), lines.filter(f"u < {upto}"), draw)
                       .selectExpr("*", f"{kind} as kind"))
        kinds = [r.kind for r in share.select("kind").distinct().collect()]
        quotas = [Quota(check_id, n, frozenset(k for k in kinds if k >> i & 1))
                  for i, (check_id, n) in enumerate(plan.items())]
        spot, short = deal_exactly(share.select("kind", "u"), quotas)
        if not any(short.values()) or not heads or upto > heads[-1][0] * step:
            break
        wanted *= 4
    if strict and any(short.values()):
        raise ValueError("too few claims for " + ", ".join(
            f"{check_id} ({n} short)" for check_id, n in short.items() if n))
    marked = share.selectExpr("*", f"{spot} as defect").selectExpr("*", f"{FORM} as form")
    return (_dirty_claims(marked, audit_date).unionByName(
                book.filter(f"u >= {upto}").select(*CLAIM_COLUMNS)),
            _dirty_remits(marked, lines.filter(f"u < {upto}")).unionByName(
                lines.filter(f"u >= {upto}").select(*REMIT_COLUMNS)),
            _ledger(marked))


# The form of a temporal defect or a bad field; a claim without a line cannot have an early remittance.
FORM = f"""case when defect = 'DQ-11' then
        case when draw % 20 < 9 and has_line then 'remit'
             when draw % 20 between 9 and 14 then 'submit' else 'future' end
    when defect = 'DQ-12' then {_pick(["cpt_code", "icd10_code", "date_of_service",
                                       "billed_amount", "patient_id"], "draw")} end"""


def _fits(spot: str) -> str:
    """Whether a claim offers what a defect needs; the others take any claim."""
    payable = "claim_status = 'PAID' and has_line"
    return f"""coalesce(case
        when {spot} in ('DQ-03', 'DQ-04', 'DQ-05', 'DQ-07') then {payable}
        when {spot} = 'DQ-06' then {payable} and (billed - line_paid > 300 or line_paid > 250)
        when {spot} = 'DQ-08' then {payable} and expected > 100 else true end, false)"""


def _marks(book: DataFrame, lines: DataFrame, draw: str) -> DataFrame:
    """Claims with what they offer to a defect: the line, amounts in cents, dates and the draw."""
    line = lines.selectExpr("claim_id", "remit_id as line_id", "true as has_line",
                            f"{_cents('paid_amount')} as line_paid")
    return book.join(line, "claim_id", "left").selectExpr(
        "*", f"abs({draw} % 1000000007L) as draw", f"{_cents('billed_amount')} as billed",
        f"{_cents('expected_allowed_amount')} as expected",
        f"{sql_safe_date('date_of_service')} as dos",
        f"{sql_safe_date('claim_submit_date')} as submit")


def _store(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "marked")
    df.hint("rebalance").write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _changed(rows: DataFrame, columns: list[str], changes: dict[str, str]) -> DataFrame:
    """`changes` holds the arms of a CASE per column; a row that takes none keeps its value."""
    return rows.selectExpr(*[f"case {changes[c]} else {c} end as {c}" if c in changes else c
                             for c in columns])


def _dirty_claims(marked: DataFrame, audit_date: dt.date) -> DataFrame:
    wrong_digit = "cast(pmod(try_cast(substr(provider_npi, 10, 1) as int) + 3, 10) as string)"
    nine = "substr(provider_npi, 1, 9)"
    later = f"cast(date_add(submit, {_between(1, 6)}) as string)"
    early = f"cast(date_sub(dos, {_between(1, 15)}) as string)"
    future = f"cast(date_add(date'{audit_date.isoformat()}', {_between(5, 90)}) as string)"
    again, other = "when again and defect = 'DQ-01' then", "when again and defect = 'DQ-02' then"
    copies = "explode(if(defect in ('DQ-01', 'DQ-02'), array(false, true), array(false))) as again"
    return _changed(marked.selectExpr("*", copies), CLAIM_COLUMNS, {
        "claim_id": f"{other} concat('RB-', claim_id)",
        "encounter_id": f"{other} concat('RB-', encounter_id)",
        "claim_submit_date": f"{other} coalesce({later}, claim_submit_date) "
                             f"when form = 'submit' then {early}",
        "claim_status": f"{other} 'PENDING'",
        "source_system": f"{again} 'ATHENA_PM'",
        "ingest_batch_id": f"{again} concat(ingest_batch_id, '-R')",
        "payer_id": f"when defect = 'DQ-09' then {_pick(BAD_PAYERS, 'draw')}",
        "payer_name": "when defect = 'DQ-09' then 'UNMAPPED'",
        "provider_npi": f"when defect = 'DQ-10' and draw % 10 < 4 then {nine} "
                        f"when defect = 'DQ-10' and draw % 10 < 7 then concat({nine}, 'X') "
                        f"when defect = 'DQ-10' then concat({nine}, {wrong_digit})",
        "date_of_service": f"when form = 'future' then {future} "
                           "when form = 'date_of_service' then ''",
        "cpt_code": f"when form = 'cpt_code' then {_pick(BAD_CPT, '(draw div 5)')}",
        "icd10_code": f"when form = 'icd10_code' then {_pick(BAD_ICD10, '(draw div 5)')}",
        "billed_amount": f"when form = 'billed_amount' then {_pick(BAD_CHARGES, '(draw div 5)')}",
        "patient_id": "when form = 'patient_id' then ''",
    })


def _dirty_remits(marked: DataFrame, remits: DataFrame) -> DataFrame:
    """Payments drift by 1.50 to 95.00 inside 0 < paid < billed, overpay by 5.00 to 60.00, or are
    cut to 72 to 88 % of the expected amount and stay balanced."""
    facts = marked.filter("defect is not null and has_line").select(
        "claim_id", "defect", "form", "draw", "billed", "expected", "dos")

    def step(room: str) -> str:
        return f"150 + draw % greatest(least({room}, 9500) - 149, 1)"

    up, down = "(billed - paid - 100)", "(paid - 100)"
    rises = f"{up} > 200 and ({down} <= 150 or draw % 2 = 0)"
    copies = "explode(if(defect in ('DQ-03', 'DQ-04'), array(false, true), array(false))) as again"
    rows = (remits.select(*REMIT_COLUMNS).join(facts, "claim_id", "left")
            .filter("coalesce(defect, '') <> 'DQ-05'")
            .selectExpr("*", f"{_cents('paid_amount')} as paid",
                        f"{_cents('patient_responsibility')} as patient_cents",
                        "(expected * (72 + draw % 17) + 50) div 100 as cut",
                        "billed + 500 + draw % 5501 as over")
            .selectExpr("*", f"if({rises}, paid + ({step(up)}), paid - ({step(down)})) as drifted",
                        "least(coalesce(patient_cents, 0), cut) as patient_cut", copies))
    again, ghost = "when again and defect = 'DQ-03' then", "when again and defect = 'DQ-04' then"
    seven, eight = "when defect = 'DQ-07' then", "when defect = 'DQ-08' then"
    early = f"cast(date_sub(dos, {_between(2, 40)}) as string)"
    return _changed(rows, REMIT_COLUMNS, {
        "remit_id": f"{again} concat('RP-', remit_id) {ghost} concat('GH-', remit_id)",
        "claim_id": f"{ghost} concat('GH-', claim_id)",
        "ingest_batch_id": f"{again} concat(ingest_batch_id, '-R')",
        "remit_date": f"when form = 'remit' then {early}",
        "allowed_amount": f"{seven} {_amount('over')} {eight} {_amount('cut')}",
        "paid_amount": f"when defect = 'DQ-06' then {_amount('drifted')} "
                       f"{seven} {_amount('over')} {eight} {_amount('cut - patient_cut')}",
        "patient_responsibility": f"{seven} '0.00' {eight} {_amount('patient_cut')}",
        "contractual_adjustment": f"{seven} '0.00' {eight} {_amount('billed - cut')}",
    })


def _ledger(marked: DataFrame) -> DataFrame:
    notes = " ".join(
        f"when '{check_id}' then " + (sql_fill(note, "claim_id") if "{}" in note else f"'{note}'")
        for check_id, note in NOTES.items())
    return marked.filter("defect is not null").selectExpr(
        "concat('INJ-', claim_id) as defect_ref", "defect as check_id",
        "if(defect in ('DQ-03', 'DQ-04'), 'remit', 'claim') as entity_type",
        "case defect when 'DQ-02' then concat('RB-', claim_id) "
        "when 'DQ-03' then concat('RP-', line_id) when 'DQ-04' then concat('GH-', line_id) "
        "else claim_id end as entity_key",
        f"case defect {notes} end as description")
