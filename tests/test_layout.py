"""Feeds in buckets of claim_id: no exchange, hot ids beside the buckets, replaced in one step."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from rows import PARAMS, claim, feeds, found, remit
from test_skew import hot_feeds

from remitwise import fixture
from remitwise.operators.layers import typed_grain
from remitwise.plans.audit import audit_laid_out, run_audit
from remitwise.sources import layout

NOW = dt.datetime(2026, 8, 28, 9, 0)
CLAIMS = [claim(i) for i in range(40)] + [claim(1, claim_id=" C1 "), claim(2, payer_id="x")]
REMITS = [remit(i) for i in range(5, 40)] + [remit(6), remit(90)]


def same_register(spark, path, claims, remits, **kw):
    raw = feeds(spark, claims, remits)
    laid = layout.lay_out(*raw, path, 4, kw.get("rows_per_task"))
    plain = run_audit(spark, *raw, fixture.payers(spark), PARAMS, "RUN-1", NOW, **kw)
    other = audit_laid_out(spark, laid, fixture.payers(spark), PARAMS, "RUN-1", NOW, **kw)
    assert found(other.register) == found(plain.register)
    assert found(other.layer.grain) == found(plain.layer.grain)
    return laid


def test_grain_needs_no_exchange(spark, tmp_path):
    laid = same_register(spark, str(tmp_path), CLAIMS, REMITS)
    assert not laid.has_loose
    grain = typed_grain(laid.claims, laid.remits, fixture.payers(spark), True)
    grain.collect()
    plan = grain._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan
    folder = next(f for f in os.listdir(tmp_path) if f.startswith("feeds-"))
    files = [f for f in os.listdir(tmp_path / folder / "claims") if f.endswith(".parquet")]
    assert len(files) <= 4


def test_hot_ids_stay_beside_the_buckets(spark, tmp_path):
    claims, remits = hot_feeds()
    claims += [claim(5000, claim_id=None)]
    laid = same_register(spark, str(tmp_path), claims, remits, rows_per_task=30)
    assert laid.has_loose
    assert {r[0] for r in laid.loose_remits.select("claim_id").distinct().collect()} == {
        "C1", "C3000", "C2000", None}
    assert laid.remits.groupBy("claim_id").count().filter("count > 30").count() == 0
    assert laid.claims.filter("claim_id is null or claim_id = 'C1'").count() == 0
    lines = laid.lines
    assert lines.select("line_no").distinct().count() == lines.count() == len(remits)


def test_empty_feeds(spark, tmp_path):
    same_register(spark, str(tmp_path), [], [])
    same_register(spark, str(tmp_path), [], REMITS)
    same_register(spark, str(tmp_path), CLAIMS, [])


def test_layout_is_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="no feeds"):
        layout.open_layout(spark, path)
    first = layout.lay_out(*feeds(spark, CLAIMS, REMITS), path, 4)

    def dies(*_):
        raise OSError("disk")

    with monkeypatch.context() as m:
        m.setattr(layout, "publish", dies)
        with pytest.raises(OSError, match="disk"):
            layout.lay_out(*feeds(spark, CLAIMS[:1], REMITS), path, 4)
    # Another session knows no table of the layout.
    other = layout.open_layout(spark.newSession(), path)
    assert other.claims.count() == first.claims.count() == len(CLAIMS)
    for table in [t.name for t in spark.catalog.listTables() if t.name.startswith("laid_out_")]:
        spark.sql(f"drop table {table}")
    assert layout.open_layout(spark, path).claims.count() == len(CLAIMS)
    layout.lay_out(*feeds(spark, CLAIMS[:1], REMITS), path, 4)
    assert first.claims.count() == len(CLAIMS)  # the one before stays for its readers
    layout.lay_out(*feeds(spark, CLAIMS[:2], REMITS), path, 4)
    assert len([f for f in os.listdir(path) if f.startswith("feeds-")]) == 2
    assert layout.open_layout(spark, path).claims.count() == 2
