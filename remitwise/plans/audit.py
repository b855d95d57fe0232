"""A full audit run: layer, checks, register and reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from remitwise.operators.checks import Params, exceptions_by_entity
from remitwise.operators.layers import (LAYER_READS, Layer, bucketed_grain, build_layer,
                                        flagged_lines, store, typed_grain)
from remitwise.operators.skew import is_small
from remitwise.plans import crossfoot, operations, reports
from remitwise.plans.figures import Figures, take_figures
from remitwise.plans.register import exception_register, read_register, run_folder, write_run
from remitwise.schemas import check_catalog
from remitwise.sources import exports
from remitwise.sources.landing import require_key
from remitwise.sources.layout import LaidOutFeeds
from remitwise.sources.scratch import scratch_path
from remitwise.sources.steps import Steps, fingerprints
from remitwise.sources.versions import published


class EntryRefused(ValueError):
    """A table that the run needs is absent, empty, short, or has lines set aside."""


class PublicationRefused(ValueError):
    """The run summary and the cross-foot do not agree."""


@dataclass(frozen=True)
class Audit:
    """A finished run: its layer, its part of the register, and the reports over both.

    The reports read `figures`, which the first of them writes below the layer's folder.
    """

    layer: Layer
    register: DataFrame
    catalog: DataFrame
    ledger: DataFrame | None = None

    @cached_property
    def figures(self) -> Figures:
        return take_figures(self.layer.claims, self.register, self.layer.path)

    def dq_summary(self) -> DataFrame:
        return reports.summary_rows(self.figures.found_by_check(), self.figures.claims(),
                                    self.catalog)

    def control_totals(self) -> DataFrame:
        return self.figures.control_totals()

    def payer_scorecard(self) -> DataFrame:
        by_payer = f"{reports.PAYER} as payer_id"
        return reports.scorecard_rows(self.figures.claims_by(by_payer),
                                      self.figures.found_by(by_payer), self.layer.payers)

    def severity_mix(self) -> DataFrame:
        return crossfoot.severity_rows(self.figures.found_by("severity"), self.catalog)

    def payer_scorecard_total(self) -> DataFrame:
        return crossfoot.scorecard_total_rows(self.figures.claims_by("payer_id"),
                                              self.figures.found_by("payer_id"), self.layer.payers)

    def headline(self) -> DataFrame:
        return crossfoot.headline_row(self.figures.claims(), self.figures.found(),
                                      self.layer.remits)

    def suite_validation(self) -> DataFrame:
        if self.ledger is None:
            raise ValueError("scoring needs the ledger of planted defects")
        return reports.suite_validation(self.catalog, self.ledger, self.register)

    def report_tables(self) -> dict[str, DataFrame]:
        """The reports in their printed order."""
        tables = {
            "dq_run_summary": self.dq_summary().orderBy("check_id"),
            "control_totals": self.control_totals(),
            "payer_scorecard": self.payer_scorecard().orderBy(
                "exceptions_per_1000_claims", "claims", ascending=False),
        }
        if self.ledger is not None:
            tables["suite_validation"] = self.suite_validation().orderBy("check_id")
        return tables

    def export(self, out: str, *names: str) -> None:
        """Write the CSV exports of the run below `out`: those named, `reports` or large ones
        (`exports.DELIVERIES`), or every one.
        """
        writers = {
            "reports": lambda: exports.export_reports(self.report_tables(), out),
            "exception_register": lambda: exports.export_register(self.register, out),
            "exceptions": lambda: exports.export_exceptions(self.register, out),
            "claim_reconciliation": lambda: exports.export_recon(self.layer.recon, out),
        }
        for name in names or writers:
            writers[name]()


def run_audit(spark: SparkSession, claims: DataFrame, remits: DataFrame, payers: DataFrame,
              params: Params, run_id: str, run_ts: dt.datetime, register_path: str | None = None,
              layer_path: str | None = None, ledger: DataFrame | None = None,
              rows_per_task: int | None = None) -> Audit:
    """Audit two landed feeds. A rerun of `run_id` replaces that run in the register.

    Work is cut at written tables: the layer, then the register. Without paths both go to the
    scratch folder of the session.
    """
    run_folder(run_id)
    require_key("payer_reference", payers, "payer_id")
    layer = build_layer(spark, claims, remits, payers, layer_path, rows_per_task)
    return _checked(spark, layer, params, run_id, run_ts, register_path, ledger)


def laid_out_layer(spark: SparkSession, feeds: LaidOutFeeds, payers: DataFrame,
                   path: str | None = None, rows_per_task: int | None = None) -> Layer:
    """The layer of feeds that `lay_out` wrote.

    Claims in buckets are reconciled without an exchange, those beside them as in `build_layer`. The
    lines are read where they are.
    """
    path = path or scratch_path(spark, "layer")
    small = is_small(payers)
    grain = bucketed_grain(feeds.claims, feeds.remits, payers, small, rows_per_task)
    if feeds.has_loose:
        grain = grain.unionByName(typed_grain(feeds.loose_claims, feeds.loose_remits, payers, small,
                                              rows_per_task))
    grain = store(grain, f"{path}/grain")
    flagged = store(flagged_lines(feeds.lines, grain, payers, small, rows_per_task)
                    .hint("rebalance"), f"{path}/flagged")
    return Layer(grain, feeds.lines, flagged, payers, path, rows_per_task)


def audit_laid_out(spark: SparkSession, feeds: LaidOutFeeds, payers: DataFrame, params: Params,
                   run_id: str, run_ts: dt.datetime, register_path: str | None = None,
                   layer_path: str | None = None, ledger: DataFrame | None = None,
                   rows_per_task: int | None = None) -> Audit:
    """`run_audit` over feeds that `lay_out` wrote."""
    run_folder(run_id)
    require_key("payer_reference", payers, "payer_id")
    layer = laid_out_layer(spark, feeds, payers, layer_path, rows_per_task)
    return _checked(spark, layer, params, run_id, run_ts, register_path, ledger)


def _found(layer: Layer, params: Params, run_id: str, run_ts: dt.datetime) -> DataFrame:
    of_claims, of_lines = exceptions_by_entity(layer, params)
    return exception_register(of_lines, run_id, run_ts, single=of_claims)


def _checked(spark: SparkSession, layer: Layer, params: Params, run_id: str, run_ts: dt.datetime,
             register_path: str | None, ledger: DataFrame | None) -> Audit:
    register_path = register_path or scratch_path(spark, "register")
    found = _found(layer, params, run_id, run_ts)
    write_run(found, register_path, run_id)
    return Audit(layer, read_register(spark, register_path, run_id), check_catalog(spark), ledger)


@dataclass(frozen=True)
class GuardedAudit(Audit):
    """A finished audit with the steps it was made in, and its gate before publication."""

    steps: Steps | None = None

    def disagreements(self) -> list[str]:
        """What the cross-foot and the run summary do not agree on; reads at most 16 rows."""
        detail = crossfoot.crossfoot_detail(self.layer.recon, self.register)
        footed = crossfoot.crossfoot_summary(detail, self.register)
        out = [f"{r.check_id}: register {r.register_count}, recomputed {r.recomputed_count}"
               for r in footed.filter("status <> 'AGREE'").orderBy("check_id").collect()]
        counted = reports.grouped(self.register, ["check_id"], "count(*) as held")
        summed = self.dq_summary().join(counted, "check_id", "full").filter(
            "coalesce(exceptions_found, 0L) <> coalesce(held, 0L)")
        return out + [f"{r.check_id}: summary {r.exceptions_found}, register {r.held}"
                      for r in summed.orderBy("check_id").collect()]

    def finish(self, out: str, accepted: bool = False) -> None:
        """Export the run if its summary and the cross-foot agree, then remove its step tables.

        A claim can rightly be in two payment checks, which the cross-foot shows as CHECK; `accepted`
        says that somebody has looked into the differences. The register stays.
        """
        differences = [] if accepted else self.disagreements()
        if differences:
            raise PublicationRefused("not published: " + "; ".join(differences))
        self.export(out)
        self.steps.clear()


def guarded_audit(spark: SparkSession, claims: DataFrame, remits: DataFrame, payers: DataFrame,
                  cpt: DataFrame, params: Params, run_id: str, run_ts: dt.datetime, path: str,
                  register_path: str, received: dict[str, int] | None = None,
                  rejected: dict[str, DataFrame] | None = None, ledger: DataFrame | None = None,
                  rows_per_task: int | None = None) -> GuardedAudit:
    """`run_audit` with an entry gate, taken up where a former try of it stopped.

    One pass over the inputs counts and fingerprints them. Tables that do not meet their entry
    criterion stop the run before anything is written: `received` holds announced row counts,
    `rejected` the lines set aside. Finished steps below `path` are read instead of done again as
    long as inputs, audit date, run id and time are the same; the lines flagged for the checks are
    removed once the register is written, the rest by `finish`.
    """
    run_folder(run_id)
    tables = {"claims_source": claims, "payments_remittance": remits, "payer_reference": payers,
              "cpt_reference": cpt}
    # One row per table.
    held = {r.table_name: r for r in fingerprints(tables).collect()}
    counted = spark.createDataFrame([(t, r.rows) for t, r in held.items()],
                                    "table_name string, rows_loaded bigint")
    set_aside = spark.createDataFrame([(t, df.count()) for t, df in (rejected or {}).items()],
                                      "table_name string, rows_rejected bigint")
    receipt = counted.join(set_aside, "table_name", "left").selectExpr(
        "table_name", "rows_loaded", "coalesce(rows_rejected, 0L) as rows_rejected")
    unmet = operations.entry_criteria(receipt, received).filter("criterion <> 'MET'")
    refused = [f"{r.table_name} is {r.criterion}" for r in unmet.orderBy("table_name").collect()]
    if refused:
        raise EntryRefused("run refused: " + "; ".join(refused))
    require_key("payer_reference", payers, "payer_id")

    # The flagged lines are gone once the register is written, so they are not looked for then.
    steps = Steps(spark, path, {t: r.content for t, r in held.items()},
                  f"{params} {run_id!r} {run_ts.isoformat()} {rows_per_task}")
    done = steps.finished("register")
    place = published(spark, f"{register_path}/{run_folder(run_id)}")
    if done and done.first().version != place:
        # Another run wrote the register since: it is written again.
        steps.drop("register")
        done = None

    def keep(table: str, build):
        if table == "flagged" and done:
            return None
        return steps.table(table, build, LAYER_READS.get(table))

    layer = build_layer(spark, claims, remits, payers, path, rows_per_task, keep)

    def register() -> DataFrame:
        found = _found(layer, params, run_id, run_ts)
        version = write_run(found, register_path, run_id)
        return spark.createDataFrame([(version,)], "version string")

    steps.table("register", register)
    steps.drop("flagged")
    return GuardedAudit(layer, read_register(spark, register_path, run_id), check_catalog(spark),
                        ledger, steps)
