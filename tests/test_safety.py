"""Runs, loads and exports that must not go wrong in silence."""

from decimal import Decimal

import pytest

from remitwise import fixture, schemas
from remitwise.operators.checks import all_exceptions
from remitwise.plans import crossfoot, operations
from remitwise.plans.audit import run_audit
from remitwise.plans.register import exception_register, read_register
from remitwise.sources import exports, landing
from rows import PARAMS, claim, feeds, found, layer, remit
from test_run import NOW


@pytest.mark.parametrize("run_id", ["2026/08/29", "RUN 50%25", "a:b=c", "x y"])
def test_run_ids_keep_their_findings(spark, tmp_path, run_id):
    claims, remits = feeds(spark, [claim(1), claim(2)], [remit(1)])
    audit = run_audit(spark, claims, remits, fixture.payers(spark), PARAMS, run_id, NOW,
                      register_path=str(tmp_path / "register"))
    assert [r.check_id for r in audit.register.collect()] == ["DQ-05"]
    assert read_register(spark, str(tmp_path / "register")).first().run_id == run_id


def test_a_run_needs_an_id(spark, tmp_path):
    claims, remits = feeds(spark, [claim(1)], [remit(1)])
    with pytest.raises(ValueError, match="needs an id"):
        run_audit(spark, claims, remits, fixture.payers(spark), PARAMS, "", NOW)


@pytest.mark.parametrize("more, named", [("payer_id = 'PAY-MCR-001'", "PAY-MCR-001"),
                                         ("payer_id is null", "None")])
def test_broken_master_keys_stop_the_run(spark, more, named):
    payers = fixture.payers(spark)
    extra = payers.filter("payer_id = 'PAY-MCR-001'")
    if "null" in more:
        extra = extra.selectExpr("cast(null as string) as payer_id",
                                 *[c for c in payers.columns if c != "payer_id"])
    claims, remits = feeds(spark, [claim(1)], [remit(1)])
    with pytest.raises(ValueError, match=named):
        run_audit(spark, claims, remits, payers.unionByName(extra), PARAMS, "r", NOW)


def test_triage_ranks_long_lists_in_parts(spark):
    register = spark.range(5000).selectExpr(
        "'OPEN' as disposition", "'Q' as assigned_queue", "'High' as severity", "'DQ-05' as check_id",
        "cast(id as string) as entity_key", "cast(id as string) as claim_id",
        "cast(id as decimal(18,2)) as amount_impact", "'x' as finding")
    top = operations.triage_queue(register, 2000)
    assert "xxhash64" in top._jdf.queryExecution().executedPlan().toString()
    rows = top.orderBy("queue_rank").collect()
    assert len(rows) == 2000
    assert [int(r.entity_key) for r in rows[:3]] == [4999, 4998, 4997]


def test_absurd_amounts_give_rows(spark, tmp_path):
    claims = [claim(1, billed_amount="9000000000000000")] * 3 + [claim(2)]
    remits = [remit(2, paid_amount="9999999999999999")] * 2
    run = run_audit(spark, *feeds(spark, claims, remits), fixture.payers(spark), PARAMS, "r", NOW,
                    str(tmp_path / "register"))
    impact = {r.check_id: r.amount_impact for r in run.register.collect()}
    assert impact["DQ-01"] == Decimal("18000000000000000.00")
    assert impact["DQ-03"] == Decimal("9999999999999999.00")
    line = run.layer.claim_recon.filter("claim_id = 'C2'").first()
    assert line.paid_total == Decimal("19999999999999998.00")
    assert run.dq_summary().count() == 12 and run.control_totals().count() == 1


@pytest.mark.parametrize("per_block", [1, 2, 1_000_000])
def test_copies_have_ids_of_their_own(spark, per_block):
    rows = layer(spark, [claim(1)], [remit(1)] * 6 + [remit(9, paid_amount=a) for a in "11223"])
    items = all_exceptions(rows, PARAMS)
    register = exception_register(items, "r", NOW, per_block)
    assert found(register, *schemas.EXCEPTION_COLUMNS) == found(items, *schemas.EXCEPTION_COLUMNS)
    ids = found(register, "exception_id")
    assert len(ids) == 12 and len(set(ids)) == len(ids)
    assert ids == found(exception_register(items, "r", NOW), "exception_id")


def test_malformed_rows_stop_or_are_set_aside(spark, tmp_path):
    good = ["1" for _ in schemas.CLAIM_COLUMNS]
    lines = [good, good[:-1], ["2", *good], ['""', *good[1:]], ["", *good[1:]]]
    path = tmp_path / "claims.csv"
    path.write_text("\n".join(",".join(x) for x in [schemas.CLAIM_COLUMNS, *lines]) + "\n")
    feed = landing.split_claims(spark, str(path))
    assert feed.landed.count() == 3 and feed.rejected.count() == 2
    assert found(feed.landed, "claim_id") == [("",), ("1",), (None,)]
    assert found(feed.rejected, "line") == sorted([(",".join(lines[1]),), (",".join(lines[2]),)])
    receipt = landing.load_receipt({"claims": feed.landed, "b": spark.range(2)},
                                   {"claims": feed.rejected})
    assert found(operations.entry_criteria(receipt, {"b": 1, "c": 2}), "table_name", "rows_rejected",
                 "criterion") == [("b", "0", "SURPLUS"), ("c", None, "ABSENT"),
                                  ("claims", "2", "REJECTS")]
    with pytest.raises(Exception, match="malformed row"):
        landing.read_claims(spark, str(path)).count()


@pytest.mark.parametrize("row", ["12001,Repair,free", "12001,,5.00", "12001,Repair", ",Repair,5.00"])
def test_bad_master_rows_stop_a_count(spark, tmp_path, row):
    path = tmp_path / "cpt.csv"
    path.write_text(f"cpt_code,cpt_description,standard_charge\n{row}\n")
    with pytest.raises(Exception, match="malformed row"):
        landing.load_receipt({"cpt_reference": landing.read_cpt(spark, str(path))}).collect()


def test_exports_of_edge_text_read_back(spark, tmp_path):
    edge = 'a\n"b", \\N c\r\\ '
    claims = [claim(1, claim_id="", cpt_code="9\n9", payer_name=edge, payer_id="X"),
              claim(2, cpt_code="\\N", payer_name=" y ", claim_submit_date=""), claim(3),
              claim(3, source_system=edge), claim(4, patient_id="P2", cpt_code="\\N")]
    run = run_audit(spark, *feeds(spark, claims, [remit(2), remit(9, remit_id="")] * 2),
                    fixture.payers(spark), PARAMS, "r", NOW, str(tmp_path / "register"))
    out = str(tmp_path / "out")
    run.export(out)
    back = exports.read_exports(spark, out)
    register, recon = back["exception_register"], back["claim_reconciliation"]
    assert found(register, *schemas.REGISTER_EXPORT_COLUMNS) == found(
        run.register, *schemas.REGISTER_EXPORT_COLUMNS)
    assert found(recon, *schemas.RECON_EXPORT_COLUMNS) == found(
        run.layer.recon, *schemas.RECON_EXPORT_COLUMNS)
    assert found(exports.read_exceptions(spark, out), *schemas.EXCEPTION_COLUMNS) == found(
        run.register, *schemas.EXCEPTION_COLUMNS)
    assert found(crossfoot.crossfoot_detail(recon, register)) == found(
        crossfoot.crossfoot_detail(run.layer.recon, run.register))
    for check in schemas.ROUTING:
        files = list((tmp_path / "out" / "exceptions" / f"evidence={check[5]}").glob("*.csv"))
        assert files and files[0].read_text().startswith("check_id,"), check[0]
