"""Runs, register, exports, sources and the operating rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from rows import PARAMS, claim, feeds, found, layer, remit

from remitwise import fixture, schemas
from remitwise.operators.checks import all_exceptions
from remitwise.operators.layers import open_layer
from remitwise.plans import crossfoot, operations, register, reports
from remitwise.plans.audit import run_audit
from remitwise.sources import exports, landing

NOW = dt.datetime(2026, 8, 28, 9, 0)  # a Friday
CLAIMS = [claim(1), claim(1, ingest_batch_id="B1-R", source_system="A, \"B\""),
          claim(2, payer_name='Acme "Gold", Inc', payer_id="ACME"), claim(3),
          claim(4, cpt_code="x"), claim(5, payer_id="")]
REMITS = [remit(1), remit(2), remit(4, paid_amount="50.00"), remit(5), remit(8)]


def audit(spark, tmp_path, run_id="RUN-1", claims=CLAIMS, remits=REMITS, **kw):
    c, r = feeds(spark, claims, remits)
    return run_audit(spark, c, r, fixture.payers(spark), PARAMS, run_id, NOW,
                     str(tmp_path / "register"), **kw)


def test_rerun_replaces_its_run_only(spark, tmp_path):
    first = audit(spark, tmp_path)
    before = found(first.register, "exception_id")
    audit(spark, tmp_path, "RUN-2")
    again = audit(spark, tmp_path)
    assert found(again.register, "exception_id") == before and len(set(before)) == len(before)
    both = register.read_register(spark, str(tmp_path / "register"))
    assert found(both.groupBy("run_id").count(), "run_id", "count") == [
        ("RUN-1", str(len(before))), ("RUN-2", str(len(before)))]
    clean = audit(spark, tmp_path, "RUN-1", [claim(1)], [remit(1)])
    assert clean.register.count() == 0
    assert both.filter("run_id = 'RUN-2'").count() == len(before)
    register.write_register(both.filter("run_id = 'RUN-2'").limit(1), str(tmp_path / "register"))
    assert register.read_register(spark, str(tmp_path / "register"), "RUN-2").count() == 1


def test_register_columns(spark, tmp_path):
    row = audit(spark, tmp_path).register.filter("check_id = 'DQ-06'").first()
    assert (row.assigned_queue, row.disposition, row.resolved_ts) == (
        "Payment Variance", "OPEN", None)
    assert row.run_ts == NOW and row.severity == "CRITICAL"


def test_exports_round_trip(spark, tmp_path):
    out = str(tmp_path / "out")
    run = audit(spark, tmp_path)
    run.export(out)
    back = exports.read_exports(spark, out)
    for name, source, columns in (
            ("exception_register", run.register, schemas.REGISTER_EXPORT_COLUMNS),
            ("claim_reconciliation", run.layer.claim_recon, schemas.RECON_EXPORT_COLUMNS)):
        assert found(back[name], *columns) == found(source, *columns), name
    assert found(exports.read_exceptions(spark, out), *schemas.EXCEPTION_COLUMNS) == found(
        run.register, *schemas.EXCEPTION_COLUMNS)
    keys = [tuple(r) for r in back["exception_register"].select("check_id", "entity_key").collect()]
    assert keys == sorted(keys)
    detail = crossfoot.crossfoot_detail(back["claim_reconciliation"], back["exception_register"])
    assert found(detail.groupBy("agreement").count(), "agreement", "count") == [("AGREE", "5")]
    header = spark.read.option("header", True).csv(f"{out}/dq_run_summary").columns
    assert header[:5] == ["check_id", "check_name", "dimension", "severity", "exceptions_found"]


def test_csv_landing(spark, tmp_path):
    claims, remits = feeds(spark, CLAIMS, REMITS)
    for name, df in (("claims", claims), ("remits", remits)):
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(
            str(tmp_path / name))
    back = landing.read_claims(spark, str(tmp_path / "claims"))
    assert back.schema == schemas.CLAIMS
    assert found(back.na.fill("")) == found(claims.na.fill(""))
    assert found(landing.read_remits(spark, str(tmp_path / "remits"))) == found(remits)
    landed = landing.land(back, str(tmp_path / "landed"))
    assert landed.count() == landing.land(back, str(tmp_path / "landed")).count() == len(CLAIMS)


def test_master_data_is_strict(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('cpt_code,cpt_description,standard_charge\n12001,"Repair, ""small""",196.00\n')
    bad.write_text("cpt_code,cpt_description,standard_charge\n12001,Repair,free\n")
    assert landing.read_cpt(spark, str(good)).first().cpt_description == 'Repair, "small"'
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        landing.read_cpt(spark, str(bad)).collect()
    payer = tmp_path / "payer.csv"
    payer.write_text("payer_id,payer_name,payer_type,contract_rate\nP1,A,B,0.62\n")
    assert landing.read_payers(spark, str(payer)).first().contract_rate == Decimal("0.62")
    ledger = tmp_path / "ledger.csv"
    ledger.write_text("defect_ref,check_id,entity_type,entity_key,description\nI1,DQ-01,claim,C,d\n")
    assert landing.read_ledger(spark, str(ledger)).first().entity_key == "C"


def test_reference_violations(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), ("b", None)],
                               "k string, p string")
    parent = spark.createDataFrame([("x",)], "p string")
    got = landing.reference_violations("t", df, ["k"], ["p"], parent)
    assert found(got, "rule", "column_name", "key_value", "rows") == [
        ("FOREIGN KEY", "p", "y", "1"), ("NOT NULL", "k", "<null>", "1"),
        ("NOT NULL", "p", "b", "1"), ("UNIQUE", "k", "a", "2")]


def test_layer_reopens(spark):
    rows = layer(spark, CLAIMS, REMITS)
    again = open_layer(spark, rows.payers, rows.path)
    assert found(all_exceptions(again, PARAMS)) == found(all_exceptions(rows, PARAMS))
    assert found(again.claim_recon, "claim_id", "carc_codes", "check_eft_numbers") == [
        ("C1", "45", "EFT1"), ("C2", "45", "EFT2"), ("C3", None, None), ("C4", "45", "EFT4"),
        ("C5", "45", "EFT5")]
    assert again.remit_by_claim.count() == 5 and again.claim_unique.count() == 5


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    path = tmp_path / "c.csv"
    row = ",".join('"a\nb"' if c == "payer_name" else "1" for c in schemas.CLAIM_COLUMNS)
    path.write_text(",".join(schemas.CLAIM_COLUMNS) + "\n" + row + "\n")
    assert landing.read_claims(spark, str(path), multi_line=True).first().payer_name == "a\nb"


def test_crossfoot_without_any_exception(spark):
    rows = layer(spark, [claim(1), claim(2, claim_status="PENDING")], [remit(1)])
    empty = register.exception_register(all_exceptions(rows, PARAMS), "R", NOW)
    detail = crossfoot.crossfoot_detail(rows.claim_recon, empty)
    assert found(detail, "claim_id", "verdict", "agreement") == [
        ("C1", "BALANCED", "AGREE"), ("C2", "NO REMITTANCE", "AGREE")]
    assert {r.status for r in crossfoot.crossfoot_summary(detail, empty).collect()} == {"AGREE"}
    assert reports.suite_validation(schemas.check_catalog(spark),
                                    spark.createDataFrame([], schemas.LEDGER), empty).count() == 12


def test_crossfoot_shows_where_the_two_differ(spark):
    claims = [claim(1, billed_amount="0.00"), claim(2)]
    rows = layer(spark, claims, [remit(2, paid_amount="junk")])
    reg = register.exception_register(all_exceptions(rows, PARAMS), "R", NOW)
    detail = crossfoot.crossfoot_detail(rows.claim_recon, reg)
    assert found(detail, "claim_id", "verdict", "register_check", "agreement") == [
        ("C1", "INVALID CHARGE", "DQ-05", "CHECK"), ("C2", "MISMATCH", None, "CHECK")]


def items(spark, rows):
    names = ["run_id", "check_id", "severity", "entity_key", "payer_id", "amount_impact",
             "disposition", "disposition_reason"]
    df = spark.createDataFrame(
        [(r.get("run_id", "R1"), r["check_id"], schemas.SEVERITY[r["check_id"]],
          r.get("entity_key", "C1"), r.get("payer_id"), Decimal(r.get("amount_impact", "1")),
          r.get("disposition", "OPEN"), r.get("disposition_reason")) for r in rows],
        "run_id string, check_id string, severity string, entity_key string, payer_id string, "
        "amount_impact decimal(18,2), disposition string, disposition_reason string")
    assert df.columns == names
    return df.selectExpr("*", "entity_key as claim_id", "'f' as finding",
                         f"{register.sql_assigned_queue()} as assigned_queue",
                         "timestamp'2026-08-28 09:00:00' as run_ts",
                         "cast(null as timestamp) as resolved_ts")


def test_triage_order(spark):
    reg = items(spark, [{"check_id": "DQ-12", "entity_key": "a", "amount_impact": "900"},
                        {"check_id": "DQ-02", "entity_key": "b", "amount_impact": "5"},
                        {"check_id": "DQ-02", "entity_key": "c", "amount_impact": "-7"},
                        {"check_id": "DQ-02", "entity_key": "d", "disposition": "RESOLVED"}])
    ranked = operations.triage_queue(reg, 2).orderBy("queue_rank").collect()
    assert [r.entity_key for r in ranked] == ["c", "b"]
    assert [r.entity_key for r in operations.worklist(reg).collect()] == ["c", "b", "a"]


def test_sla_counts_weekdays(spark):
    reg = items(spark, [{"check_id": c} for c in ("DQ-01", "DQ-05", "DQ-11")])
    got = found(operations.sla_ageing(reg, dt.datetime(2026, 8, 31, 12)), "check_id", "due_ts",
                "sla_status")
    assert got == [("DQ-01", "2026-08-29 09:00:00", "BREACHED"),
                   ("DQ-05", "2026-09-03 00:00:00", "IN TIME"),
                   ("DQ-11", "2026-09-05 00:00:00", "IN TIME")]


def test_escalations(spark):
    rows = [{"check_id": "DQ-06", "entity_key": "a", "amount_impact": "-500.01"},
            {"check_id": "DQ-06", "entity_key": "b", "amount_impact": "500"}]
    rows += [{"check_id": "DQ-05"} for _ in range(10)]
    rows += [{"check_id": "DQ-08", "payer_id": "P1"} for _ in range(25)]
    rows += [{"check_id": "DQ-08", "payer_id": "P2", "amount_impact": "5000"}]
    rows += [{"check_id": "DQ-08", "amount_impact": "4999.99"} for _ in range(1)]
    assert found(operations.escalations(items(spark, rows)), "check_id", "scope_key", "items") == [
        ("DQ-05", "R1", "10"), ("DQ-06", "a", "1"), ("DQ-08", "P1", "25"), ("DQ-08", "P2", "1")]


def test_unmatched_payments_wait_for_business_days(spark):
    # The run is of a Friday: its second business day, a Tuesday, ends with the first of September.
    reg = items(spark, [{"check_id": "DQ-04", "entity_key": "a", "amount_impact": "7"},
                        {"check_id": "DQ-04", "entity_key": "a", "amount_impact": "-2"},
                        {"check_id": "DQ-04", "entity_key": "b", "disposition": "RESOLVED"},
                        {"check_id": "DQ-05", "entity_key": "c"}])
    assert operations.unmatched_payments(reg, dt.datetime(2026, 9, 2)).count() == 0
    assert found(operations.unmatched_payments(reg, dt.datetime(2026, 9, 2, 0, 1)), "scope_key",
                 "items", "exposure_usd", "escalate_to") == [("a", "2", "9.00", "Payer")]


def test_repeating_feeds(spark):
    runs = spark.createDataFrame([(f"R{i}", f"2026-08-0{i}") for i in range(1, 5)],
                                 "run_id string, run_ts string")
    sources = {"C1": "A", "C2": "A", "C3": "B", "C4": None}
    claims = spark.createDataFrame(list(sources.items()), "claim_id string, source_system string")
    # A: other claims, but run after run. B: with a clean run between. Unknown sources count too.
    seen = [("C1", 1), ("C2", 2), ("C3", 1), ("C3", 3), ("C4", 3), ("C4", 4)]
    reg = items(spark, [{"check_id": "DQ-11", "entity_key": c, "run_id": f"R{i}"} for c, i in seen])
    assert found(operations.repeating_feeds(reg, claims, runs), "scope_key", "first_run", "last_run",
                 "items") == [("A", "R1", "R2", "2"), ("UNKNOWN", "R3", "R4", "2")]


def test_repeat_defects_count_clean_runs(spark):
    runs = spark.createDataFrame([(f"R{i}", f"2026-08-0{i}") for i in range(1, 9)],
                                 "run_id string, run_ts string")
    seen = {"DQ-01": [1, 2, 3], "DQ-02": [1, 2, 4, 5], "DQ-03": [5, 6, 7, 8], "DQ-04": [1, 3, 5]}
    reg = items(spark, [{"check_id": c, "run_id": f"R{i}"} for c, n in seen.items() for i in n])
    assert found(operations.repeat_defects(reg, runs), "check_id", "consecutive_runs",
                 "first_run", "last_run") == [("DQ-01", "3", "R1", "R3"), ("DQ-03", "4", "R5", "R8")]
    by_item = operations.repeat_defects(reg, runs, ["check_id", "entity_key"])
    assert by_item.count() == 2


def test_disposition_rules(spark):
    reg = items(spark, [
        {"check_id": "DQ-05", "entity_key": "a"},
        {"check_id": "DQ-05", "entity_key": "b", "disposition": None},
        {"check_id": "DQ-05", "entity_key": "c", "disposition": "DONE"},
        {"check_id": "DQ-05", "entity_key": "d", "disposition": "WAIVED"},
        {"check_id": "DQ-05", "entity_key": "e", "disposition": "WAIVED",
         "disposition_reason": "small"},
        {"check_id": "DQ-05", "entity_key": "f", "disposition": "RESOLVED",
         "disposition_reason": "fixed"},
        {"check_id": "DQ-01", "entity_key": "g"}])
    got = operations.disposition_violations(reg, dt.datetime(2026, 8, 31))
    assert found(got, "entity_key", "violation") == [
        ("b", "no disposition"), ("c", "unknown disposition"), ("d", "closed without a reason"),
        ("f", "resolved without a time"), ("g", "open past its SLA")]


def test_entry_criteria(spark):
    receipt = landing.load_receipt({"a": spark.range(3), "b": spark.range(0), "c": spark.range(2)})
    assert found(operations.entry_criteria(receipt, {"a": 4, "c": 2}), "table_name",
                 "criterion") == [("a", "SHORT"), ("b", "EMPTY"), ("c", "MET")]


def test_reports_read_one_run(spark, tmp_path):
    run = audit(spark, tmp_path)
    summary = {r.check_id: r for r in run.dq_summary().collect()}
    assert summary["DQ-01"].exceptions_found == 1 and summary["DQ-01"].result == "FAIL"
    assert summary["DQ-11"].result == "PASS" and summary["DQ-11"].financial_impact_usd == 0
    assert str(summary["DQ-01"].exception_rate_pct) == "20.000"
    totals = run.control_totals().first()
    assert (totals.claims_in_scope, totals.claims_with_remittance) == (5, 4)
    assert totals.variance_adjudicated == Decimal("50.00")
    cards = {r.payer_id: r for r in run.payer_scorecard().collect()}
    assert cards["UNMAPPED"].payer_name == "Unmapped / unknown payer"
    with pytest.raises(ValueError, match="ledger"):
        run.suite_validation()
