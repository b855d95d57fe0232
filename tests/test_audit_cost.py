"""What an audit does per claim: sums, groups and scans that it can do without."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from rows import PARAMS, claim, found, layer, remit

from remitwise.operators.checks import all_exceptions_fused, dq02, exceptions_by_entity
from remitwise.plans import register as registers
from remitwise.plans.figures import AMOUNTS, book_cells

NOW = dt.datetime(2026, 8, 28, 9, 0)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cells_add_small_amounts_as_numbers(spark):
    """Amounts on both sides of a million, negative and absent ones give the plain sums."""
    wide = ["999999.99", "1000000.00", "-999999.99", "-1000000.00", "9999999999999999.00", "0.01",
            "9999999999999999.00", "", "185.00"]
    built = layer(spark, [claim(n, billed_amount=a) for n, a in enumerate(wide)],
                  [remit(n, paid_amount=a) for n, a in enumerate(wide[:-2])])
    cells = book_cells(built.claims)
    assert "UnscaledValue" in plan_of(cells)
    assert {cells.schema[name].dataType.simpleString() for name in AMOUNTS} == {"decimal(38,2)"}
    total = {name: sum((r[name] or Decimal(0) for r in cells.collect()), Decimal(0))
             for name in AMOUNTS}
    assert total["billed_total"] == sum(Decimal(a or 0) for a in wide)
    assert total["paid_total"] == sum(Decimal(a or 0) for a in wide[:-2])
    assert total["billed_total_adjudicated"] == sum(Decimal(a) for a in wide[:-2])
    missing = [r.billed_total_adjudicated for r in cells.collect()
               if r.verdict == "NO REMITTANCE (PAID)"]
    assert missing == [None]


def test_exceptions_of_claims_are_not_grouped(spark):
    """They get the ids that grouping gives; copies of a line keep ids of their own."""
    claims = [claim(1), claim(1, ingest_batch_id="B2"), claim(2, cpt_code="x"), claim(3, payer_id=""),
              claim(4, encounter_id="E9", patient_id="P3"), claim(None, claim_id=None, patient_id="")]
    built = layer(spark, claims, [remit(1)] * 3 + [remit(9)] * 2)
    of_claims, of_lines = exceptions_by_entity(built, PARAMS)
    kinds = Counter(r.entity_type for r in of_claims.collect())
    assert kinds["claim"] >= 5 and set(kinds) == {"claim"}
    split = registers.exception_register(of_lines, "r", NOW, single=of_claims)
    whole = registers.exception_register(all_exceptions_fused(built, PARAMS), "r", NOW)
    assert split.columns == whole.columns and found(split) == found(whole)
    apart = registers.exception_register(of_lines.limit(0), "r", NOW, single=of_claims)
    assert found(apart, "exception_id") == found(whole.filter("entity_type = 'claim'"),
                                                 "exception_id")


def test_claims_with_a_fingerprint_seen_twice_are_read_once(spark):
    built = layer(spark, [claim(1), claim(2, patient_id="P1"), claim(3)], [])
    later = dq02(built, PARAMS)
    assert [r.claim_id for r in later.collect()] == ["C2"]
    assert not [f for f in later.inputFiles() if "/grain/" in f]
