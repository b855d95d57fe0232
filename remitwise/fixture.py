"""Claims and remittances derived from an `orders` table by integer rules, with planted defects.

`k` is the order key and `k % 100` picks the defect, so the rule itself is the defect ledger.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from remitwise import schemas

AUDIT_DATE = dt.date(2001, 12, 31)

# Tasks that a large table is dealt to, per core.
TASKS_PER_CORE = 4

# The payer master, columns payer_id, payer_name, payer_type, contract_rate.
PAYER_ROWS = [
    ("PAY-MCR-001", "Medicare Part B", "MEDICARE", "0.62"),
    ("PAY-MCD-002", "State Medicaid", "MEDICAID", "0.48"),
    ("PAY-BCB-003", "Blue Cross Blue Shield", "COMMERCIAL", "0.71"),
    ("PAY-UHC-004", "UnitedHealthcare", "COMMERCIAL", "0.68"),
    ("PAY-AET-005", "Aetna", "COMMERCIAL", "0.69"),
    ("PAY-CIG-006", "Cigna", "COMMERCIAL", "0.67"),
    ("PAY-HUM-007", "Humana Medicare Advantage", "MEDICARE", "0.64"),
    ("PAY-TRC-008", "TRICARE East", "GOVERNMENT", "0.60"),
    ("PAY-WCP-009", "Workers Compensation Fund", "WORKCOMP", "0.75"),
]
# The CPT charge master, columns cpt_code, cpt_description, standard_charge.
CPT_ROWS = [
    ("12001", "Simple wound repair, 2.5 cm or less", "196.00"),
    ("20610", "Arthrocentesis, major joint", "223.00"),
    ("36415", "Routine venipuncture", "18.00"),
    ("71046", "Chest X-ray, 2 views", "97.00"),
    ("73630", "Foot X-ray, complete", "89.00"),
    ("80053", "Comprehensive metabolic panel", "62.00"),
    ("85025", "Complete blood count with differential", "48.00"),
    ("87635", "SARS-CoV-2 amplified probe technique", "102.00"),
    ("90471", "Immunization administration", "41.00"),
    ("93000", "Electrocardiogram, complete", "74.00"),
    ("99203", "Office visit, new patient, 30-44 min", "248.00"),
    ("99204", "Office visit, new patient, 45-59 min", "375.00"),
    ("99213", "Office visit, established patient, 20-29 min", "185.00"),
    ("99214", "Office visit, established patient, 30-39 min", "264.00"),
    ("99215", "Office visit, established patient, 40-54 min", "369.00"),
    ("99396", "Preventive visit, established, 40-64 yrs", "312.00"),
]
# Provider numbers with a right check digit, and one with a wrong one.
NPIS = ["1234567893", "1311111102", "1387654316", "1464197528", "1540740739"]
BAD_NPI = "1234567896"


def payers(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(PAYER_ROWS, schemas.PAYERS.fieldNames())
    return rows.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}"
                             for f in schemas.PAYERS])


def cpt(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(CPT_ROWS, schemas.CPT.fieldNames())
    return rows.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}"
                             for f in schemas.CPT])


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def _orders(spark: SparkSession, sf_dir: str, defects: bool) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    cores = spark.sparkContext.defaultParallelism
    splits = orders.rdd.getNumPartitions()
    if splits < cores:
        # A small file is one split; the rows derived from it would keep one core busy.
        orders = orders.repartition(cores)
    elif splits < TASKS_PER_CORE * cores:
        # Splits hold whole row groups, some of them twice as many as others, and rows become wide.
        orders = orders.repartition(TASKS_PER_CORE * cores, "o_orderkey")
    billed = "cast(100 + o_orderkey % 400 as decimal(18,2))"
    return orders.selectExpr(
        "o_orderkey as k",
        f"{'o_orderkey % 100' if defects else '-1L'} as r",
        "cast(o_orderdate as date) as dos",
        "concat('CLM-', lpad(o_orderkey, 10, '0')) as claim_id",
        f"{billed} as billed",
        f"cast({billed} * 0.60 as decimal(18,2)) as expected",
        "case when o_orderkey % 100 between 90 and 95 then 'PENDING' "
        "when o_orderkey % 100 >= 96 then 'DENIED' else 'PAID' end as status")


def claims(spark: SparkSession, sf_dir: str, defects: bool = True) -> DataFrame:
    """The claims landing table."""
    npi = _pick(NPIS, "k % 5")
    values = {
        "claim_id": "case when copy = 'rebill' then concat('CLM-9', substr(claim_id, 6)) "
                    "else claim_id end",
        "patient_id": "case when r = 12 and k % 500 = 12 then '' else concat('PT-', k) end",
        "encounter_id": "concat('ENC-', k)",
        "provider_npi": f"case when r = 10 and k % 200 = 10 then substr({npi}, 1, 9) "
                        f"when r = 10 then '{BAD_NPI}' else {npi} end",
        "facility_id": "concat('FAC-0', 1 + k % 5)",
        "place_of_service": "'11'",
        "payer_id": "case when r = 9 and k % 200 = 9 then '' when r = 9 then 'PAY-XXX-999' "
                    f"else {_pick([p[0] for p in PAYER_ROWS], 'k % 9')} end",
        "payer_name": "case when r = 9 then 'UNMAPPED' "
                      f"else {_pick([p[1] for p in PAYER_ROWS], 'k % 9')} end",
        "date_of_service": "case when r = 11 and k % 200 = 11 then '2026-09-29' "
                           "when r = 13 then '' else cast(dos as string) end",
        "claim_submit_date": "cast(case when copy = 'rebill' then date_add(dos, 20) "
                             "when r = 14 then date_sub(dos, 3) "
                             "else date_add(dos, cast(1 + k % 10 as int)) end as string)",
        "cpt_code": "case when r = 15 then 'ABCDE' else '99213' end",
        "icd10_code": "case when r = 16 then 'E119' else 'E11.9' end",
        "units": "'1'",
        "billed_amount": "case when r = 17 then '-125.00' else cast(billed as string) end",
        "expected_allowed_amount": "cast(expected as string)",
        "claim_status": "case when copy = 'rebill' then 'PENDING' else status end",
        "source_system": "case when copy = 'resend' then 'ATHENA_PM' else 'EPIC_PB' end",
        "ingest_batch_id": "case copy when 'resend' then 'BATCH-1-R' when 'rebill' then 'BATCH-2' "
                           "else 'BATCH-1' end",
    }
    copies = ("explode(case when r = 1 then array('own', 'resend') "
              "when r = 2 then array('own', 'rebill') else array('own') end) as copy")
    return (_orders(spark, sf_dir, defects).selectExpr("*", copies)
            .selectExpr(*[f"{values[c]} as {c}" for c in schemas.CLAIM_COLUMNS]))


def remits(spark: SparkSession, sf_dir: str, defects: bool = True) -> DataFrame:
    """The remittances landing table."""
    allowed = ("case when status = 'DENIED' then 0 when r = 7 then billed + 50 "
               "when r = 8 then expected * 0.80 else expected end")
    values = {
        "remit_id": "concat(copy, k)",
        "claim_id": "case when copy = 'RMT-G' then concat('CLM-8', substr(claim_id, 6)) "
                    "else claim_id end",
        "payer_id": _pick([p[0] for p in PAYER_ROWS], "k % 9"),
        "check_eft_number": "concat('EFT', k)",
        "remit_date": "cast(case when r = 18 then date_sub(dos, 5) else date_add(dos, 30) end "
                      "as string)",
        "allowed_amount": "cast(allowed as string)",
        "paid_amount": "cast(cast(case when r = 6 then expected - 5 else allowed end "
                       "as decimal(18,2)) as string)",
        "patient_responsibility": "'0.00'",
        "contractual_adjustment": "cast(cast(case when r = 7 then 0 else billed - allowed end "
                                  "as decimal(18,2)) as string)",
        "carc_code": "case when status = 'DENIED' then '16' else '45' end",
        "carc_description": "case when status = 'DENIED' "
                            "then 'Claim lacks information or has submission/billing error' "
                            "else 'Charge exceeds fee schedule/contracted rate' end",
        "claim_status_code": "case when status = 'DENIED' then '4' else '1' end",
        "posted_flag": "'Y'",
        "ingest_batch_id": "'ERA-1'",
    }
    copies = ("explode(case when r = 3 then array('RMT-', 'RMT-D') "
              "when r = 4 then array('RMT-', 'RMT-G') else array('RMT-') end) as copy")
    return (_orders(spark, sf_dir, defects).filter("status <> 'PENDING' and r <> 5")
            .selectExpr("*", f"cast({allowed} as decimal(18,2)) as allowed", copies)
            .selectExpr(*[f"{values[c]} as {c}" for c in schemas.REMIT_COLUMNS]))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per planted defect."""
    check = ("case when r between 1 and 10 then concat('DQ-', lpad(r, 2, '0')) "
             "when (r = 11 and k % 200 = 11) or r in (14, 18) then 'DQ-11' "
             "when (r = 12 and k % 500 = 12) or r in (13, 15, 16, 17) then 'DQ-12' end")
    key = ("case r when 2 then concat('CLM-9', substr(claim_id, 6)) when 3 then concat('RMT-D', k) "
           "when 4 then concat('RMT-G', k) else claim_id end")
    return (_orders(spark, sf_dir, True)
            .selectExpr("concat('INJ-', k) as defect_ref", f"{check} as check_id",
                        "case when r in (3, 4) then 'remit' else 'claim' end as entity_type",
                        f"{key} as entity_key",
                        "concat('planted by residue ', r) as description")
            .filter("check_id is not null"))
