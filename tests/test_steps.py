"""Runs that refuse unmet input, resume after a failure, and clear what they wrote."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from rows import PARAMS, claim, feeds, found, remit

from remitwise import fixture
from remitwise.operators import layers
from remitwise.plans import audit
from remitwise.plans.register import read_register, write_run
from remitwise.sources.steps import Steps, fingerprint

NOW = dt.datetime(2026, 8, 28, 9, 0)
CLAIMS = [claim(i) for i in range(6)] + [claim(7, cpt_code="x"), claim(1, ingest_batch_id="B2")]
REMITS = [remit(i) for i in range(5)] + [remit(9), remit(2, remit_id="R2b"), remit(7)]


def guarded(spark, tmp_path, claims=CLAIMS, remits=REMITS, payers=None, **kw):
    c, r = feeds(spark, claims, remits)
    return audit.guarded_audit(
        spark, c, r, fixture.payers(spark) if payers is None else payers, fixture.cpt(spark), PARAMS,
        kw.pop("run_id", "RUN-1"), NOW, str(tmp_path / "run"), str(tmp_path / "register"), **kw)


def steps_on_disk(tmp_path):
    path = tmp_path / "run"
    return sorted(n.rpartition("-")[0] for n in os.listdir(path)) if path.exists() else []


def test_fingerprint(spark):
    def content(rows, schema="a string, b string"):
        return fingerprint(spark.createDataFrame(rows, schema)).first().content

    one = content([("x", None), ("y", "z")])
    assert one == content([("y", "z"), ("x", None)])
    others = [content([(None, "x"), ("y", "z")]), content([("x", None)]), content([]),
              content([("x", None), ("y", "z"), ("y", "z")]), content([("x", ""), ("y", "z")]),
              content([("x", None), ("y", "z")], "a string, c string"),
              # Pairs of equal rows, which an exclusive or does not see.
              content([("x", None), ("y", "z"), ("p", "p"), ("p", "p")]),
              content([("x", None), ("y", "z"), ("q", "q"), ("q", "q")])]
    assert len({one, *others}) == len(others) + 1
    twice = spark.sql("select 1 as a, 2 as a, 'x' as `odd.name`")
    assert fingerprint(twice).first().rows == 1


def test_a_step_is_taken_up_for_its_inputs_only(spark, tmp_path):
    path = str(tmp_path / "run")

    def steps(a="1", b="1", settings=""):
        return Steps(spark, path, {"a": a, "b": b}, settings)

    def never():
        raise AssertionError("built again")

    first = steps()
    assert first.table("s", lambda: spark.range(3), ("a",)).count() == 3
    other = steps(b="2", settings="x")
    assert other.table("s", never, ("a",)).count() == 3 and other.taken_up == ["s"]
    assert steps().table("all", lambda: spark.range(1)).count() == 1
    with pytest.raises(AssertionError):
        steps(settings="x").table("all", never)
    assert steps(a="2").table("s", lambda: spark.range(4), ("a",)).count() == 4
    assert steps_on_disk(tmp_path) == ["all", "s"]  # the superseded table is gone
    with pytest.raises(AssertionError):
        steps().table("s", never, ("a",))
    first.clear()
    assert not os.path.exists(path)


def test_a_run_goes_on_after_the_step_that_died(spark, tmp_path, monkeypatch):
    def dies(*_, **__):
        raise RuntimeError("the machine died")

    with monkeypatch.context() as m:
        m.setattr(layers, "flagged_lines", dies)
        with pytest.raises(RuntimeError, match="the machine died"):
            guarded(spark, tmp_path)
    assert steps_on_disk(tmp_path) == ["grain", "remits"]
    assert read_register(spark, str(tmp_path / "register")).count() == 0

    with monkeypatch.context() as m:
        # Neither feed may be typed again: both tables are there.
        m.setattr(layers, "typed_remits", dies)
        m.setattr(layers, "typed_claims", dies)
        second = guarded(spark, tmp_path)
    assert second.steps.taken_up == ["remits", "grain"]
    assert second.steps.written == ["flagged", "register"]
    assert steps_on_disk(tmp_path) == ["grain", "register", "remits"]
    c, r = feeds(spark, CLAIMS, REMITS)
    plain = audit.run_audit(spark, c, r, fixture.payers(spark), PARAMS, "RUN-1", NOW)
    assert found(second.register) == found(plain.register) and second.register.count() > 0
    assert found(second.dq_summary()) == found(plain.dq_summary())

    third = guarded(spark, tmp_path)
    assert third.steps.written == [] and found(third.register) == found(plain.register)
    third.finish(str(tmp_path / "out"), accepted=True)
    assert steps_on_disk(tmp_path) == [] and os.path.isdir(tmp_path / "out" / "control_totals")
    assert read_register(spark, str(tmp_path / "register")).count() == plain.register.count()


def test_other_input_or_a_replaced_register_is_done_again(spark, tmp_path):
    first = guarded(spark, tmp_path)
    more = guarded(spark, tmp_path, [*CLAIMS, claim(8)])
    assert more.steps.taken_up == ["remits"]
    assert more.register.count() == first.register.count() + 1  # a claim without a line
    rows = found(more.register)
    write_run(more.register.limit(1), str(tmp_path / "register"), "RUN-1")
    again = guarded(spark, tmp_path, [*CLAIMS, claim(8)])
    assert again.steps.taken_up == ["remits", "grain"]
    assert found(again.register) == rows and len(rows) > 1
    assert guarded(spark, tmp_path, [*CLAIMS, claim(8)], run_id="RUN-2").steps.written == [
        "grain", "flagged", "register"]


def test_unmet_entry_criteria_stop_the_run(spark, tmp_path):
    c, _ = feeds(spark, CLAIMS[:1], REMITS)
    for kw, told in (
            ({"remits": []}, "payments_remittance is EMPTY"),
            ({"received": {"claims_source": 9}}, "claims_source is SHORT"),
            ({"received": {"claims_source": 1}}, "claims_source is SURPLUS"),
            ({"received": {"ledger": 1}}, "ledger is ABSENT"),
            ({"rejected": {"claims_source": c}}, "claims_source is REJECTS"),
            ({"payers": fixture.payers(spark).limit(0)}, "payer_reference is EMPTY")):
        with pytest.raises(audit.EntryRefused, match=told):
            guarded(spark, tmp_path, **kw)
    assert not (tmp_path / "run").exists() and not (tmp_path / "register").exists()
    met = guarded(spark, tmp_path, received={"claims_source": len(CLAIMS)})
    assert met.register.count() > 0


def test_publication_waits_for_agreement(spark, tmp_path):
    run = guarded(spark, tmp_path, [claim(1), claim(2)], [remit(1)])
    assert run.disagreements() == []
    rest = run.register.filter("check_id <> 'DQ-06' and claim_id <> 'C2'")
    lost = audit.GuardedAudit(run.layer, rest, run.catalog, None, run.steps)
    with pytest.raises(audit.PublicationRefused, match="ALL: register 2, recomputed 1"):
        lost.finish(str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() and steps_on_disk(tmp_path)
    run.finish(str(tmp_path / "out"))
    assert steps_on_disk(tmp_path) == []
