"""Each check on hand-made rows at its edges."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from rows import PARAMS, claim, feeds, found, layer, remit

from remitwise import fixture
from remitwise.operators.checks import CHECKS, Params, all_exceptions, all_exceptions_fused
from remitwise.operators.layers import build_layer, claim_unique, typed_claims


def run(spark, check_id, claims, remits, *columns, **kw):
    return found(CHECKS[check_id](layer(spark, claims, remits, **kw), PARAMS), *columns)


def test_clean_rows_raise_nothing(spark):
    rows = layer(spark, [claim(i) for i in range(5)], [remit(i) for i in range(5)])
    assert all_exceptions(rows, PARAMS).count() == 0


def test_dq01_counts_every_extra_row(spark):
    claims = [claim(1), claim(1, source_system="ATHENA_PM", ingest_batch_id="B1-R"),
              claim(1, ingest_batch_id="B0", billed_amount="200.00"), claim(2),
              claim(3, claim_id=None), claim(3, claim_id=None)]
    assert run(spark, "DQ-01", claims, [remit(1), remit(2)], "entity_key", "billed_amount",
               "amount_impact", "finding") == [
        ("C1", "200.00", "400.00", "claim_id received 3 times (source systems: ATHENA_PM, EPIC_PB; "
                                   "batches: B0, B1, B1-R)")]


def test_first_row_does_not_depend_on_input_order(spark):
    rows = [claim(1, patient_id=p, source_system=s, ingest_batch_id=b)
            for p in ("A", "B", None) for s in ("X", None) for b in ("B1", "B2", None)]
    kept = set()
    for order in (rows, rows[::-1], rows[5:] + rows[:5]):
        claims, _ = feeds(spark, order, [])
        kept |= set(found(claim_unique(typed_claims(claims.repartition(3))), "patient_id",
                          "source_system", "ingest_batch_id"))
    assert kept == {(None, "X", "B1")}


def test_dq02_reports_all_but_the_earliest(spark):
    same = {"patient_id": "P1"}
    claims = [claim(3, claim_submit_date="2026-01-12", **same), claim(1, **same),
              claim(2, claim_submit_date="2026-01-11", **same),
              claim(4, claim_submit_date="", **same), claim(5, patient_id=""),
              claim(6, patient_id=""), claim(7, billed_amount="0", patient_id="Z"),
              claim(8, billed_amount="0", patient_id="Z")]
    got = run(spark, "DQ-02", claims, [], "entity_key", "finding")
    assert [k for k, _ in got] == ["C1", "C3", "C4"]
    assert got[0][1] == ("duplicate of C2 - same patient, provider, date of service, CPT and "
                         "charge; submitted 2026-01-12")
    assert got[2][1].endswith("; submitted ")


def test_dq03_null_check_number_and_equal_copies(spark):
    twice = remit(1)
    remits = [twice, dict(twice), dict(twice), remit(2, check_eft_number=None),
              remit(2, remit_id="R2b", check_eft_number=""), remit(3),
              remit(3, remit_id="R3b", paid_amount="99.00"), remit(9, claim_id=None),
              remit(9, claim_id="")]
    got = run(spark, "DQ-03", [claim(1), claim(2), claim(3)], remits, "entity_key", "claim_id",
              "billed_amount", "amount_impact", "finding")
    assert [(r[0], r[1]) for r in got] == [("R1", "C1"), ("R1", "C1"), ("R2b", "C2")]
    assert got[0][2:] == ("185.00", "100.00", "second posting of claim C1 on check EFT1 for 100.00 "
                                              "(original posting R1)")
    assert got[2][4] == "second posting of claim C2 on check  for 100.00 (original posting R2)"


def test_dq04_null_and_blank_claim_ids(spark):
    claims = [claim(1), claim(2, claim_id="")]
    remits = [remit(1), remit(2, claim_id=""), remit(3, claim_id=None),
              remit(4, payer_id="PAY-CIG-006"), remit(4, remit_id="R4b")]
    got = run(spark, "DQ-04", claims, remits, "entity_key", "claim_id", "payer_name",
              "date_of_service", "billed_amount", "amount_impact", "finding")
    assert [r[0] for r in got] == ["R2", "R3", "R4", "R4b"]
    assert got[0][1] is None and "claim <null>," in got[0][6]
    assert got[2][1:6] == ("C4", "Cigna", None, None, "100.00")
    assert got[2][6] == ("remittance posted on 2026-02-01 against claim C4, which is absent from "
                         "the claims feed (check EFT4)")


def test_orphan_posted_twice_is_in_both_checks(spark):
    rows = layer(spark, [claim(1)], [remit(1), remit(2), remit(2, remit_id="R2b")])
    assert found(all_exceptions(rows, PARAMS), "check_id", "entity_key") == [
        ("DQ-03", "R2b"), ("DQ-04", "R2"), ("DQ-04", "R2b")]


def test_dq05_with_bad_charge_is_in_dq12_too(spark):
    claims = [claim(1), claim(2, claim_status="PENDING"), claim(3, billed_amount="0.00")]
    rows = layer(spark, claims, [])
    assert found(all_exceptions(rows, PARAMS), "check_id", "entity_key") == [
        ("DQ-05", "C1"), ("DQ-05", "C3"), ("DQ-12", "C3")]
    assert found(CHECKS["DQ-05"](rows, PARAMS), "finding")[0] == (
        "claim status is PAID but no remittance line exists; submitted 2026-01-12, charge 0.00",)


def test_dq06_tolerance_and_exclusions(spark):
    claims = [claim(i) for i in range(1, 7)]
    remits = [remit(1, paid_amount="99.99"), remit(2, paid_amount="99.98"),
              remit(3, paid_amount="100.02"), remit(4, paid_amount="junk"),
              remit(5, paid_amount="50"), remit(5, remit_id="R5b", paid_amount="51"),
              remit(6, paid_amount="190.00")]
    got = run(spark, "DQ-06", claims, remits, "entity_key", "amount_impact", "finding")
    assert [r[:2] for r in got] == [("C2", "0.02"), ("C3", "-0.02")]
    assert got[0][2] == ("billed 185.00 vs accounted 184.98 (paid 99.98 + patient resp 0.00 + "
                         "adjustment 85.00); variance 0.02")
    loose = Params(PARAMS.audit_date, tolerance=Decimal("0.02"))
    assert CHECKS["DQ-06"](layer(spark, claims, remits), loose).count() == 0


def test_dq07(spark):
    remits = [remit(1, paid_amount="185.00", contractual_adjustment="0"),
              remit(2, paid_amount="219.17")]
    assert run(spark, "DQ-07", [claim(1), claim(2)], remits, "entity_key", "amount_impact",
               "finding") == [("C2", "34.17", "paid 219.17 against a billed charge of 185.00; "
                                              "overpaid by 34.17 (check EFT2)")]


def test_dq08_floor_is_open(spark):
    remits = [remit(1, allowed_amount="90.00"), remit(2, allowed_amount="89.99"),
              remit(3, allowed_amount="0.00"), remit(4, allowed_amount="50", claim_status_code="4"),
              remit(5, allowed_amount="50")]
    claims = [claim(i) for i in range(1, 5)] + [claim(5, expected_allowed_amount="0")]
    assert run(spark, "DQ-08", claims, remits, "entity_key", "amount_impact", "finding") == [
        ("C2", "10.01", "allowed 89.99 against a contracted expectation of 100.00 "
                        "(10.0% below contract)")]


def test_dq09_and_dq10_messages(spark):
    claims = [claim(1, payer_id="PAY-BCB-03", payer_name="UNMAPPED"), claim(2, payer_id=" "),
              claim(3, payer_id="Z", payer_name=None), claim(4, provider_npi="776728045X"),
              claim(5, provider_npi=""), claim(6, provider_npi="2437857530")]
    rows = layer(spark, claims, [remit(i) for i in range(1, 7)])
    assert found(CHECKS["DQ-09"](rows, PARAMS), "finding") == [
        ("payer_id PAY-BCB-03 is not present in the payer master (claim carries name "
         "\"UNMAPPED\")",),
        ("payer_id Z is not present in the payer master (claim carries name \"<null>\")",),
        ("payer_id is blank on the claim record",)]
    assert found(CHECKS["DQ-10"](rows, PARAMS), "finding") == [
        ("provider_npi \"776728045X\" is not 10 numeric digits",),
        ("provider_npi 2437857530 fails the Luhn check digit",), ("provider_npi is blank",)]


def test_dq11_lists_every_rule_once_per_claim(spark):
    claims = [claim(1, date_of_service="2026-08-29", claim_submit_date="2026-08-29"),
              claim(2, date_of_service="2026-09-29"),
              claim(3), claim(4), claim(5, date_of_service="")]
    remits = [remit(1, remit_date="2026-08-29"), remit(2, remit_date="2026-09-28"),
              remit(3, remit_date="2026-01-09"), remit(3, remit_id="R3b"),
              remit(4, remit_date="2026-01-10"), remit(5)]
    assert run(spark, "DQ-11", claims, remits, "entity_key", "amount_impact", "finding") == [
        ("C2", "0.00", "remittance dated before the date of service; claim submitted 2026-01-12, "
                       "before the date of service 2026-09-29; date of service 2026-09-29 is in "
                       "the future (audit date 2026-08-29)"),
        ("C3", "0.00", "remittance dated before the date of service")]


def test_dq12_lists_every_field(spark):
    claims = [claim(1, patient_id="", date_of_service="2026-02-30", cpt_code="", icd10_code=" ",
                    billed_amount="x"),
              claim(2, cpt_code=" ABCDE ", icd10_code="U07.1", billed_amount="-125.00"),
              claim(3, icd10_code="I10")]
    assert run(spark, "DQ-12", claims, [remit(3)], "entity_key", "amount_impact", "finding") == [
        ("C1", "0.00", "patient_id blank; date_of_service blank or unparseable; cpt_code blank; "
                       "icd10_code blank; billed_amount blank or unparseable"),
        ("C2", "-125.00", "cpt_code \"ABCDE\" is malformed; icd10_code \"U07.1\" is malformed; "
                          "billed_amount is -125.00")]


def test_audit_date_is_a_parameter(spark):
    rows = layer(spark, [claim(1)], [remit(1)])
    assert CHECKS["DQ-11"](rows, Params(dt.date(2026, 1, 9))).count() == 1
    assert CHECKS["DQ-11"](rows, Params(dt.date(2026, 1, 10))).count() == 0


def test_fused_equals_separate(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = build_layer(spark, fixture.claims(spark, sf_dir), fixture.remits(spark, sf_dir),
                       fixture.payers(spark))
    params = Params(fixture.AUDIT_DATE)
    one, two = all_exceptions(rows, params), all_exceptions_fused(rows, params)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    assert one.schema.names == two.schema.names


def test_empty_feeds(spark):
    rows = layer(spark, [], [])
    assert all_exceptions(rows, PARAMS).count() == 0
    assert all_exceptions_fused(rows, PARAMS).count() == 0
