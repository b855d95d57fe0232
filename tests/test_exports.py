"""Deliveries that prove themselves."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from rows import PARAMS, claim, feeds, found, remit

from remitwise import fixture
from remitwise.plans.audit import run_audit
from remitwise.sources import exports


@pytest.fixture(scope="module")
def run(spark):
    # Every claim has a bad provider number, so the register is long enough for several files.
    c, r = feeds(spark, [claim(i, provider_npi="1") for i in range(400)], [remit(i) for i in range(390)])
    return run_audit(spark, c, r, fixture.payers(spark), PARAMS, "RUN-1", dt.datetime(2026, 8, 28))


def parts(folder):
    return sorted(n for n in os.listdir(folder) if n.startswith("part-"))


@pytest.fixture
def delivered(spark, run, tmp_path):
    """An export in several files."""
    out = str(tmp_path / "out")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run.export(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return out


def test_manifest(spark, run, delivered):
    files = exports.manifest(spark, delivered, "claim_reconciliation").orderBy("part").collect()
    assert len(files) > 1 and sum(f.rows for f in files) == 400
    assert sum(f.amount for f in files) == run.layer.recon.agg({"billed_amount": "sum"}).first()[0]
    for one, two in zip(files, files[1:]):
        assert one.first_key <= one.last_key <= two.first_key
    order = exports.delivery_order(spark, delivered).collect()
    assert all(r.overlaps == 0 for r in order)
    assert {(r.export, r.folder) for r in order} == {
        ("exception_register", ""), ("claim_reconciliation", ""),
        *[("exceptions", f"evidence={e}") for e, in found(
            run.register.join(exports.check_routing(spark), "check_id").select("evidence").distinct())]}
    assert exports.read_delivery(spark, delivered, "claim_reconciliation").count() == 400


@pytest.mark.parametrize("harm, told", [("lost", "missing"), ("repeated", "not of this delivery"),
                                        ("changed", "changed"), ("renamed", "changed")])
def test_a_broken_delivery_is_not_read(spark, delivered, tmp_path, harm, told):
    bad = str(tmp_path / "bad")
    gone = parts(f"{delivered}/claim_reconciliation")[1]

    def skipped(folder, names):  # a checksum file would tell before we do
        crc = [n for n in names if n.endswith(".crc")]
        return crc + ([gone] if harm == "lost" and folder.endswith("claim_reconciliation") else [])

    shutil.copytree(delivered, bad, ignore=skipped)
    folder = f"{bad}/claim_reconciliation"
    if harm == "repeated":
        shutil.copyfile(f"{folder}/{gone}", f"{folder}/part-99999-again.csv")
    if harm in ("changed", "renamed"):
        with open(f"{folder}/{gone}") as f:
            text = f.read()
        # Another key of the same length leaves every total as it was.
        lines = text.splitlines(keepends=True)
        text = text.replace("185.00", "158.00", 1) if harm == "changed" else "".join(
            [lines[0], lines[1].replace("C", "D", 1), *lines[2:]])
        with open(f"{folder}/{gone}", "w") as f:
            f.write(text)
    with pytest.raises(exports.DeliveryBroken, match=f"{gone if harm != 'repeated' else 'again'}.* is {told}"):
        exports.read_exports(spark, bad)
    assert exports.read_delivery(spark, bad, "exceptions").count() > 0
    assert exports.read_exports(spark, delivered)["claim_reconciliation"].count() == 400


def test_files_out_of_order_are_told(spark, run, tmp_path):
    out = str(tmp_path / "out")
    run.export(out)
    shuffled = run.layer.recon.repartition(4, "claim_id")
    exports._write(shuffled.select(*exports.schemas.RECON_EXPORT_COLUMNS), f"{out}/claim_reconciliation")
    exports._deliver(spark, out, "claim_reconciliation")
    overlaps = {r.export: r.overlaps for r in exports.delivery_order(spark, out).filter("folder = ''").collect()}
    assert overlaps["claim_reconciliation"] > 0 and overlaps["exception_register"] == 0


def test_an_empty_register_is_delivered(spark, tmp_path):
    c, r = feeds(spark, [claim(1)], [remit(1)])
    clean = run_audit(spark, c, r, fixture.payers(spark), PARAMS, "RUN-1", dt.datetime(2026, 8, 28))
    out = str(tmp_path / "out")
    clean.export(out)
    assert exports.read_exports(spark, out)["exception_register"].count() == 0
    assert exports.read_exceptions(spark, out).count() == 0
    assert found(exports.delivery_order(spark, out), "export", "rows") == [("claim_reconciliation", "1")]
