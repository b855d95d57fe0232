"""Hand-made landing rows: a clean claim and its line, with the named fields replaced."""

from __future__ import annotations

import datetime as dt

from remitwise import fixture, schemas
from remitwise.operators.checks import Params
from remitwise.operators.layers import build_layer

PARAMS = Params(dt.date(2026, 8, 29))

CLAIM = {
    "claim_id": "C1", "patient_id": "P1", "encounter_id": "E1", "provider_npi": "1234567893",
    "facility_id": "F1", "place_of_service": "11", "payer_id": "PAY-MCR-001",
    "payer_name": "Medicare Part B", "date_of_service": "2026-01-10",
    "claim_submit_date": "2026-01-12", "cpt_code": "99213", "icd10_code": "E11.9", "units": "1",
    "billed_amount": "185.00", "expected_allowed_amount": "100.00", "claim_status": "PAID",
    "source_system": "EPIC_PB", "ingest_batch_id": "B1",
}
REMIT = {
    "remit_id": "R1", "claim_id": "C1", "payer_id": "PAY-MCR-001", "check_eft_number": "EFT1",
    "remit_date": "2026-02-01", "allowed_amount": "100.00", "paid_amount": "100.00",
    "patient_responsibility": "0.00", "contractual_adjustment": "85.00", "carc_code": "45",
    "carc_description": "x", "claim_status_code": "1", "posted_flag": "Y",
    "ingest_batch_id": "ERA1",
}


def claim(n, **fields):
    """Clean claim number `n`, alone in its fingerprint."""
    return {**CLAIM, "claim_id": f"C{n}", "patient_id": f"P{n}", **fields}


def remit(n, **fields):
    """The line that balances claim number `n`."""
    return {**REMIT, "remit_id": f"R{n}", "claim_id": f"C{n}", "check_eft_number": f"EFT{n}",
            **fields}


def feeds(spark, claims, remits):
    return (spark.createDataFrame([tuple(c[k] for k in schemas.CLAIM_COLUMNS) for c in claims],
                                  schemas.CLAIMS),
            spark.createDataFrame([tuple(r[k] for k in schemas.REMIT_COLUMNS) for r in remits],
                                  schemas.REMITS))


def layer(spark, claims, remits, rows_per_task=None, payers=None):
    c, r = feeds(spark, claims, remits)
    return build_layer(spark, c, r, payers or fixture.payers(spark), rows_per_task=rows_per_task)


def found(df, *columns):
    """Rows of the named columns, or of all, as text in a fixed order."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(None if v is None else str(v) for v in row) for row in rows),
                  key=lambda row: [(v is None, v or "") for v in row])
