"""Registered queries do their own work only."""

from __future__ import annotations

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


def test_the_register_is_read_as_the_run_wrote_it(spark, monkeypatch):
    """The checks have run once when the audit is finished; the query does not run them again."""
    held = contract._audit(spark, SF_DIR).register
    for name in ("all_exceptions", "all_exceptions_fused"):
        monkeypatch.setattr(contract.checks, name, None)
    got = contract.queries()["exception_register"](spark, SF_DIR)
    assert got.columns == held.columns
    assert got.count() == held.count() > 0 and not got.exceptAll(held).count()


def test_a_query_exports_what_it_reads_back(spark, monkeypatch):
    """Of the whole run's exports, each query writes those that it returns."""
    audit, seen = contract._audit(spark, SF_DIR), []
    for name in ("export_reports", "export_register", "export_exceptions", "export_recon"):
        real = getattr(contract.exports, name)
        monkeypatch.setattr(contract.exports, name, lambda *a, name=name, real=real: (
            seen.append(name), real(*a)))
    queries = contract.queries()
    found = queries["export_exceptions"](spark, SF_DIR)
    assert seen == ["export_exceptions"] and found.count() == audit.register.count()
    seen.clear()
    queries["crossfoot_from_exports"](spark, SF_DIR)
    assert seen == ["export_register", "export_recon"]
