"""Positive and negative control on planted books."""

from __future__ import annotations

import datetime as dt

import pytest
from rows import PARAMS, claim, feeds, remit

from remitwise import fixture
from remitwise.operators.checks import CHECKS, Params, all_exceptions_fused
from remitwise.operators.layers import build_layer
from remitwise.operators.planting import _spot, plant_defects, plant_exactly
from remitwise.operators.selection import Quota, deal_exactly
from remitwise.plans import operations, reports
from remitwise.plans.register import exception_register
from remitwise.schemas import check_catalog

SF_DIR = "/root/testdata/sf0.001"
FIXTURE_PARAMS = Params(fixture.AUDIT_DATE)
NOW = dt.datetime(2001, 12, 31)


@pytest.mark.parametrize("seed", [1, 20])
def test_hash_planting_is_found_in_full(spark, seed):
    plan = dict.fromkeys(CHECKS, 40)
    claims, remits, ledger = plant_defects(
        fixture.claims(spark, SF_DIR, False), fixture.remits(spark, SF_DIR, False),
        fixture.AUDIT_DATE, plan, seed)
    layer = build_layer(spark, claims, remits, fixture.payers(spark))
    register = exception_register(all_exceptions_fused(layer, FIXTURE_PARAMS), "R", NOW)
    scores = reports.suite_validation(check_catalog(spark), ledger, register).collect()
    assert len(scores) == 12
    for row in scores:
        assert row.injected_defects > 10, row
        assert row.suite_result == "PASS", row
    again = plant_defects(fixture.claims(spark, SF_DIR, False).repartition(5),
                          fixture.remits(spark, SF_DIR, False), fixture.AUDIT_DATE, plan, seed)[2]
    assert again.exceptAll(ledger).count() == 0
    claims_hit = ledger.selectExpr("substr(defect_ref, 5) as c")
    assert claims_hit.distinct().count() == claims_hit.count()


def test_exact_numbers_are_planted_and_found(spark):
    plan = dict(zip(CHECKS, [9, 14, 7, 12, 6, 31, 4, 20, 5, 7, 8, 13], strict=True))
    claims, remits = (f(spark, SF_DIR, False) for f in (fixture.claims, fixture.remits))
    dirty, lines, ledger = plant_exactly(claims, remits, fixture.AUDIT_DATE, plan, seed=4)
    register = exception_register(all_exceptions_fused(
        build_layer(spark, dirty, lines, fixture.payers(spark)), FIXTURE_PARAMS), "R", NOW)
    scores = reports.suite_validation(check_catalog(spark), ledger, register).collect()
    assert {r.check_id: r.injected_defects for r in scores} == plan
    assert {r.suite_result for r in scores} == {"PASS"}
    assert dirty.count() == claims.count() + plan["DQ-01"] + plan["DQ-02"]
    assert lines.count() == remits.count() + plan["DQ-03"] + plan["DQ-04"] - plan["DQ-05"]


def test_a_book_too_small_for_its_plan(spark):
    claims, remits = (f(spark, SF_DIR, False) for f in (fixture.claims, fixture.remits))
    with pytest.raises(ValueError, match="DQ-05 .*short"):
        plant_exactly(claims, remits, fixture.AUDIT_DATE, {"DQ-01": 10, "DQ-05": 5000})
    some = plant_exactly(claims, remits, fixture.AUDIT_DATE, {"DQ-01": 10, "DQ-05": 5000},
                         strict=False)[2]
    paid = claims.filter("claim_status = 'PAID'").count()
    assert paid - 10 <= some.filter("check_id = 'DQ-05'").count() <= paid
    assert plant_exactly(claims.limit(0), remits.limit(0), fixture.AUDIT_DATE, {}, 1)[2].count() == 0


def test_dealing_against_one_row_at_a_time(spark):
    """Crowded order values, so that quotas fill up inside buckets on every level."""
    rows = [(i % 4, (i * 7919 % 3001) << 9 | i % 3) for i in range(3000)]
    quotas = [Quota("a", 301, frozenset({1, 3})), Quota("b", 1, frozenset({0, 1})),
              Quota("c", 700, frozenset({2, 3})), Quota("d", 650, frozenset({0, 1, 2, 3}))]
    left, want = {q.name: q.number for q in quotas}, {}
    for kind, u in sorted(rows, key=lambda r: r[1]):
        name = next((q.name for q in quotas if kind in q.kinds and left[q.name]), None)
        if name:
            left[name] -= 1
            want[u] = name
    df = spark.createDataFrame(rows, "kind int, u bigint")
    spot, short = deal_exactly(df, quotas)
    got = {r.u: r.name for r in df.selectExpr("u", f"{spot} as name").collect() if r.name}
    assert got == want and short == left


def test_no_room_means_no_defect(spark):
    claims, remits = feeds(
        spark, [claim(i, billed_amount="1.00", expected_allowed_amount="1.00") for i in range(50)],
        [remit(i, paid_amount="1.00", allowed_amount="1.00", contractual_adjustment="0")
         for i in range(50)])
    dirty = plant_defects(claims, remits, PARAMS.audit_date, {"DQ-06": 500, "DQ-08": 500})
    assert dirty[2].count() == 0
    assert dirty[0].exceptAll(claims).count() == 0 and dirty[1].exceptAll(remits).count() == 0


def test_clean_book_raises_nothing(spark):
    layer = build_layer(spark, fixture.claims(spark, SF_DIR, False),
                        fixture.remits(spark, SF_DIR, False), fixture.payers(spark))
    control = reports.negative_control(all_exceptions_fused(layer, FIXTURE_PARAMS),
                                       check_catalog(spark))
    assert [(r.false_positives, r.result) for r in control.collect()] == [(0, "PASS")] * 12
    summary = reports.dq_summary(
        exception_register(all_exceptions_fused(layer, FIXTURE_PARAMS), "R", NOW),
        layer.claim_unique, check_catalog(spark))
    assert operations.run_verdict(summary, layer.claim_unique).first().verdict == "PASS"


def test_the_bucket_of_a_claim_is_worked_out_once(spark):
    """Not once per check of the plan, for every claim and line of the book."""
    planted = plant_defects(
        fixture.claims(spark, "/root/testdata/sf0.001", False),
        fixture.remits(spark, "/root/testdata/sf0.001", False), fixture.AUDIT_DATE,
        bucket="pmod(crc32(claim_id), 1000)")
    for table in planted[:2]:
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        tests = [line.count("crc32") for line in plan.splitlines() if "Filter" in line]
        assert sum(tests) and max(tests) <= 2
    spots = spark.range(-1, 6).selectExpr(
        f"{_spot({'DQ-01': 2, 'DQ-02': 0, 'DQ-03': 1}, 'cast(id as int)')} as spot")
    assert [r.spot for r in spots.collect()] == [None, "DQ-01", "DQ-01", "DQ-03", None, None, None]
