"""Schemas, the check catalogue and the other fixed values of the audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
# Sums, products and differences of amounts: no number of lines overflows it.
TOTAL = "decimal(38,2)"

CLAIM_COLUMNS = [
    "claim_id", "patient_id", "encounter_id", "provider_npi", "facility_id", "place_of_service",
    "payer_id", "payer_name", "date_of_service", "claim_submit_date", "cpt_code", "icd10_code",
    "units", "billed_amount", "expected_allowed_amount", "claim_status", "source_system",
    "ingest_batch_id",
]
CLAIM_RAW_COLUMNS = ["date_of_service", "cpt_code", "icd10_code", "billed_amount"]
TYPED_CLAIM_COLUMNS = CLAIM_COLUMNS + [f"{c}_raw" for c in CLAIM_RAW_COLUMNS]

REMIT_COLUMNS = [
    "remit_id", "claim_id", "payer_id", "check_eft_number", "remit_date", "allowed_amount",
    "paid_amount", "patient_responsibility", "contractual_adjustment", "carc_code",
    "carc_description", "claim_status_code", "posted_flag", "ingest_batch_id",
]

ROLLUP_COLUMNS = [
    "remit_line_count", "allowed_total", "paid_total", "patient_resp_total", "adjustment_total",
    "first_remit_date", "last_remit_date", "remit_status_code", "carc_codes", "check_eft_numbers",
]

# Rollup columns that list every distinct value of a claim.
LIST_COLUMNS = ["carc_codes", "check_eft_numbers"]

RECON_COLUMNS = [
    "claim_id", "patient_id", "provider_npi", "facility_id", "payer_id", "payer_name",
    "date_of_service", "claim_submit_date", "cpt_code", "claim_status", "source_system",
    "billed_amount", "expected_allowed_amount", *ROLLUP_COLUMNS, "remit_accounted_total",
    "balance_variance",
]

# The reconciliation export leaves out the columns no consumer of the file reads.
RECON_EXPORT_COLUMNS = [
    "claim_id", "patient_id", "provider_npi", "payer_id", "payer_name", "date_of_service",
    "claim_submit_date", "cpt_code", "claim_status", "billed_amount", "expected_allowed_amount",
    "remit_line_count", "allowed_total", "paid_total", "patient_resp_total", "adjustment_total",
    "remit_accounted_total", "balance_variance",
]

EXCEPTION_COLUMNS = [
    "check_id", "severity", "entity_type", "entity_key", "claim_id", "payer_id", "payer_name",
    "date_of_service", "cpt_code", "billed_amount", "amount_impact", "finding",
]

REGISTER_EXPORT_COLUMNS = [
    "run_id", "check_id", "severity", "entity_type", "entity_key", "claim_id", "payer_id",
    "payer_name", "date_of_service", "cpt_code", "billed_amount", "amount_impact",
    "assigned_queue", "disposition", "finding",
]


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CLAIMS = _text(*CLAIM_COLUMNS)
REMITS = _text(*REMIT_COLUMNS)
LEDGER = _text("defect_ref", "check_id", "entity_type", "entity_key", "description")
PAYERS = T.StructType([
    T.StructField("payer_id", T.StringType(), False),
    T.StructField("payer_name", T.StringType(), False),
    T.StructField("payer_type", T.StringType(), False),
    T.StructField("contract_rate", T.DecimalType(5, 2), False),
])
CPT = T.StructType([
    T.StructField("cpt_code", T.StringType(), False),
    T.StructField("cpt_description", T.StringType(), False),
    T.StructField("standard_charge", T.DecimalType(12, 2), False),
])
RECON_EXPORT = T.StructType([
    T.StructField(c, T.DateType() if c.endswith(("_date", "date_of_service"))
                  else T.LongType() if c == "remit_line_count"
                  else T.DecimalType(18, 2) if c.endswith("_amount")
                  else T.DecimalType(38, 2) if c.endswith(("_total", "_variance"))
                  else T.StringType())
    for c in RECON_EXPORT_COLUMNS
])
REGISTER_EXPORT = T.StructType([
    T.StructField(c, T.DateType() if c == "date_of_service"
                  else T.DecimalType(18, 2) if c == "billed_amount"
                  else T.DecimalType(38, 2) if c == "amount_impact"
                  else T.StringType())
    for c in REGISTER_EXPORT_COLUMNS
])

# The check catalogue. Columns are check_id, check_name, dimension, severity,
# failure_condition, escalation.
CATALOG = [
    ("DQ-01", "Duplicate claim identifiers", "Uniqueness", "CRITICAL",
     "The same claim_id appears on more than one row in the claims extract.",
     "Hold the batch. Raise a P2 ticket with the interface team; do not release to the payer until "
     "the resend is collapsed to one row."),
    ("DQ-02", "Duplicate billing fingerprint", "Uniqueness", "CRITICAL",
     "Two or more distinct claim_ids share patient_id, provider_npi, date_of_service, cpt_code and "
     "billed_amount.",
     "Route to the Charge Entry lead for clinical confirmation before submission. Duplicate billing "
     "is a compliance exposure, not just a data issue."),
    ("DQ-03", "Duplicate remittance posting", "Uniqueness", "CRITICAL",
     "The same claim_id is posted more than once against the same check/EFT number for the same "
     "paid amount.",
     "Freeze posting for the affected check. Notify Cash Posting supervisor same day; reversal must "
     "be booked before month-end close."),
    ("DQ-04", "Orphaned remittance record", "Integrity", "CRITICAL",
     "A remittance line references a claim_id that does not exist in the claims extract.",
     "Return to the Cash Posting queue. If the claim cannot be located within 2 business days, "
     "escalate to the payer as an unidentified payment."),
    ("DQ-05", "Missing remittance for paid claim", "Completeness", "HIGH",
     "A claim carries status PAID in the billing system but no remittance line was received.",
     "Route to A/R Follow-up. Status is unsupported by cash; correct the claim status or locate the "
     "missing 835."),
    ("DQ-06", "Claim-to-payment amount mismatch", "Consistency", "CRITICAL",
     "billed_amount <> paid_amount + patient_responsibility + contractual_adjustment, beyond a USD "
     "0.01 rounding tolerance.",
     "Route to Payment Variance analyst with the claim and remittance evidence. Anything above USD "
     "500 goes to the Payer Relations lead the same day."),
    ("DQ-07", "Overpayment", "Consistency", "CRITICAL",
     "Total paid on a claim exceeds the billed charge.",
     "Report to Refunds/Credit Balance immediately. Overpayments carry a statutory refund clock; do "
     "not hold in a working file."),
    ("DQ-08", "Allowed amount below contract", "Consistency", "HIGH",
     "Remitted allowed_amount is more than 10% below the contracted expected_allowed_amount on an "
     "adjudicated (non-denied) claim.",
     "Bundle by payer and route to Contract Management for an underpayment appeal. Escalate at 25 "
     "claims or USD 5,000, whichever comes first."),
    ("DQ-09", "Unmapped payer identifier", "Integrity", "HIGH",
     "payer_id on the claim is blank or absent from the payer master.",
     "Return to the Enrollment/Payer Maintenance owner. Claim cannot be routed or reconciled until "
     "the payer is mapped."),
    ("DQ-10", "Invalid provider NPI", "Validity", "HIGH",
     "provider_npi is not 10 numeric digits or fails the Luhn check digit over the 80840 prefix.",
     "Return to Provider Data Management. A claim with an invalid NPI will reject at the "
     "clearinghouse."),
    ("DQ-11", "Temporal integrity break", "Timeliness", "MEDIUM",
     "Remittance dated before the date of service, claim submitted before the date of service, or a "
     "date of service in the future.",
     "Route to the source-system owner. Recurring breaks in one feed indicate a mapping or timezone "
     "defect and go to the interface team."),
    ("DQ-12", "Missing or malformed mandatory field", "Completeness", "HIGH",
     "patient_id, date_of_service, cpt_code, icd10_code or billed_amount is blank, malformed, zero "
     "or negative.",
     "Return to Charge Entry for correction. Claim is not submittable and must not be counted in "
     "reconciliation totals."),
]

# Working details of each check. Columns are check_id, assigned_queue, sla_label,
# sla_business_days (0 = 24 hours), finding_class, evidence file stem, root cause.
ROUTING = [
    ("DQ-01", "Interface / EDI", "24 hours", 0, "Duplication — claims",
     "DQ-01_duplicate_claim_ids",
     "Interface engine re-sent a batch without collapsing on the claim key."),
    ("DQ-02", "Charge Entry", "24 hours", 0, "Duplication — claims",
     "DQ-02_duplicate_billing_fingerprint",
     "Charge entry re-keyed an encounter that was already billed; no duplicate guard on the "
     "patient/DOS/CPT combination."),
    ("DQ-03", "Cash Posting", "24 hours", 0, "Duplication — payments",
     "DQ-03_duplicate_remittance_posting",
     "The same 835 file was posted twice; the posting job has no idempotency key on check number "
     "plus claim."),
    ("DQ-04", "Cash Posting", "24 hours", 0, "Match integrity",
     "DQ-04_orphaned_remittance",
     "Payer remitted against a claim number the billing system never issued - likely a payer-side "
     "claim number or a claim purged after submission."),
    ("DQ-05", "A/R Follow-up", "3 business days", 3, "Match integrity",
     "DQ-05_missing_remittance",
     "Claim status was advanced to PAID manually, or the 835 was never ingested for that check."),
    ("DQ-06", "Payment Variance", "24 hours", 0, "Payment variance",
     "DQ-06_claim_payment_mismatch",
     "Partial adjustments posted without the matching contractual write-off, so the claim no longer "
     "foots to the charge."),
    ("DQ-07", "Refunds / Credit Balance", "24 hours", 0, "Payment variance",
     "DQ-07_overpayment",
     "Payer paid above the billed charge - usually a duplicate payer-side adjudication or a "
     "coordination-of-benefits error."),
    ("DQ-08", "Contract Management", "3 business days", 3, "Contract variance",
     "DQ-08_allowed_below_contract",
     "Payer priced below the loaded contract rate; either the fee schedule is stale on their side "
     "or ours."),
    ("DQ-09", "Payer Maintenance", "3 business days", 3, "Source data quality",
     "DQ-09_unmapped_payer",
     "New payer or plan not added to the payer master before claims began flowing."),
    ("DQ-10", "Provider Data Management", "3 business days", 3, "Source data quality",
     "DQ-10_invalid_npi",
     "Provider record created without NPI validation at entry."),
    ("DQ-11", "Source System Owner", "5 business days", 5, "Source data quality",
     "DQ-11_temporal_integrity",
     "Date mapping defect in the source feed; dates are being written without timezone or sequence "
     "validation."),
    ("DQ-12", "Charge Entry", "3 business days", 3, "Source data quality",
     "DQ-12_mandatory_fields",
     "Required fields not enforced at charge entry; claims can be saved incomplete."),
]

# The order in which severities are worked.
SEVERITY_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3}

SEVERITY = {row[0]: row[3] for row in CATALOG}
QUEUE = {row[0]: row[1] for row in ROUTING}
SLA_DAYS = {row[0]: row[3] for row in ROUTING}

_CATALOG_SCHEMA = _text("check_id", "check_name", "dimension", "severity", "failure_condition",
                        "escalation")
_ROUTING_SCHEMA = ("check_id string, assigned_queue string, sla_label string, "
                   "sla_business_days int, finding_class string, evidence string, "
                   "root_cause string")


def check_catalog(spark: SparkSession) -> DataFrame:
    """The twelve checks with name, dimension, severity, failure condition and escalation."""
    return spark.createDataFrame(CATALOG, _CATALOG_SCHEMA)


def check_routing(spark: SparkSession) -> DataFrame:
    """The twelve checks with queue, SLA, finding class, evidence file and root cause."""
    return spark.createDataFrame(ROUTING, _ROUTING_SCHEMA)
