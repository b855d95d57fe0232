"""Reports from the cells of a run against the same reports from claims and register."""

from __future__ import annotations

import datetime as dt

from rows import PARAMS, claim, feeds, found, remit

from remitwise import fixture
from remitwise.plans import crossfoot, reports
from remitwise.plans.audit import run_audit
from remitwise.plans.figures import finding_cells

NOW = dt.datetime(2026, 8, 28, 9, 0)
CLAIMS = [claim(1), claim(1, ingest_batch_id="B2"), claim(2, billed_amount=""), claim(3),
          claim(4, payer_id=""), claim(5, payer_id="UNMAPPED"), claim(6, cpt_code="x"), claim(7)]
REMITS = [remit(1), remit(2), remit(4, paid_amount="50.00"), remit(5),
          # The lines of one orphan and of one repeated posting come from several payers.
          remit(8), remit(9, claim_id="C8", payer_id="PAY-COM-002"), remit(7), remit(7),
          remit(10, claim_id="")]


def audit(spark, claims=CLAIMS, remits=REMITS):
    return run_audit(spark, *feeds(spark, claims, remits), fixture.payers(spark), PARAMS, "RUN-1",
                     NOW)


def pairs(run):
    layer, register, payers = run.layer, run.register, run.layer.payers
    return {
        "summary": (run.dq_summary(),
                    reports.dq_summary(register, layer.claim_unique, run.catalog)),
        "totals": (run.control_totals(), reports.control_totals(layer.recon)),
        "scorecard": (run.payer_scorecard(),
                      reports.payer_scorecard(layer.claim_unique, register, payers)),
        "severity": (run.severity_mix(), crossfoot.severity_mix(register, run.catalog)),
        "payers": (run.payer_scorecard_total(),
                   crossfoot.payer_scorecard_total(layer.recon, register, payers)),
        "headline": (run.headline(), crossfoot.headline(layer.grain, register, layer.remits)),
    }


def test_reports_from_cells(spark):
    for name, (cells, direct) in pairs(audit(spark)).items():
        assert cells.columns == direct.columns, name
        assert cells.dtypes == direct.dtypes, name
        assert found(cells) == found(direct), name


def test_reports_of_empty_feeds(spark):
    for name, (cells, direct) in pairs(audit(spark, [], [])).items():
        assert found(cells) == found(direct), name


def test_reports_read_the_cells_only(spark):
    run = audit(spark)
    run.dq_summary().collect()
    for report in (run.dq_summary(), run.control_totals(), run.payer_scorecard(),
                   run.severity_mix(), run.payer_scorecard_total()):
        files = report.inputFiles()
        assert files and all("/figures-" in f for f in files)


def test_cells_take_one_scan(spark):
    run = audit(spark)
    plan = finding_cells(run.register)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_claim_counts_once_per_check(spark):
    run = audit(spark)
    orphan = run.dq_summary().filter("check_id = 'DQ-04'").first()
    held = {r.claim_id for r in run.register.filter("check_id = 'DQ-04'").collect()}
    assert orphan.exceptions_found > orphan.claims_affected == len(held - {None})
