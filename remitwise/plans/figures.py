"""The figures of a run that its reports share, taken in one scan of the grain and one of the register.

The grain is added up per payer and verdict, the register per check, severity and payer. These cells are
few, and every measure of a report is a sum over some of them, so the reports read the cells and no claim
or exception again. Only claims per check is not such a sum: a claim counts once per check, whatever its
payers. Grouping sets give it in the same scan, since (check, claim) is a set of its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.functions.scalars import sql_zero
from remitwise.plans.crossfoot import with_verdict
from remitwise.plans.reports import IMPACT, aggregate, grouped, sql_count
from remitwise.schemas import TOTAL

_MATCHED = "remit_line_count > 0"
_BILLED, _PAID, _PATIENT, _ADJUSTED = (sql_zero(c) for c in (
    "billed_amount", "paid_total", "patient_resp_total", "adjustment_total"))

# An amount below a million. Spark adds such amounts up as 64-bit numbers of cents, which a cell of ten
# thousand million claims cannot overflow; a sum of wider ones makes two objects a claim.
SMALL = "decimal(8,2)"

# Measures of the grain: what is added up, and for which claims.
COUNTS = {
    "claims_in_scope": "count(*)",
    "claims_with_remittance": f"count_if({_MATCHED})",
    "claims_without_remittance": "count_if(remit_line_count = 0)",
    "claim_rows": "sum(occurrences)",
}
AMOUNTS = {
    "billed_total": (_BILLED, "true"),
    "allowed_total": (sql_zero("allowed_total"), "true"),
    "paid_total": (_PAID, "true"),
    "patient_responsibility_total": (_PATIENT, "true"),
    "adjustment_total": (_ADJUSTED, "true"),
    "unreconciled_variance": (f"{_BILLED} - ({_PAID} + {_PATIENT} + {_ADJUSTED})", "true"),
    "billed_total_adjudicated": (_BILLED, _MATCHED),
    "variance_adjudicated": ("balance_variance", _MATCHED),
    "abs_variance_adjudicated": ("abs(balance_variance)", _MATCHED),
}


def book_cells(claims: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Counts and amounts of the reconciled claims per payer_id and verdict.

    `claims` are the claims of the grain. A NULL payer is a payer of its own; an empty book has no cells.
    """
    amounts = [f"_{name}" for name in AMOUNTS]
    measured = with_verdict(claims, tolerance).selectExpr(
        "payer_id", "verdict", "remit_line_count", "occurrences",
        *[f"cast(if({where}, {value}, null) as {TOTAL}) as _{name}"
          for name, (value, where) in AMOUNTS.items()])
    return grouped(
        measured.selectExpr("*", *[f"try_cast({a} as {SMALL}) as small{a}" for a in amounts]),
        ["payer_id", "verdict"], *[f"{count} as {name}" for name, count in COUNTS.items()],
        *[f"{_sum_in_parts(f'small{a}', a)} as {a[1:]}" for a in amounts])


def _sum_in_parts(small: str, amount: str) -> str:
    """The sum of amounts: those that `small` holds in one 64-bit number, the few others exactly too."""
    parts = f"sum({small})", f"sum({amount}) filter (where {small} is null and {amount} is not null)"
    return f"cast(coalesce({' + '.join(parts)}, {', '.join(parts)}) as {TOTAL})"


def finding_cells(register: DataFrame) -> DataFrame:
    """Exceptions and impact per check, severity and payer_id; claims affected per check.

    The rows with `of_check` carry `claims` alone, the others `found` and `impact`. Both come from one
    scan; a claim with any number of exceptions leaves it as one row per input split.
    """
    check, severity, payer, claim = (F.col(c) for c in (
        "check_id", "severity", "payer_id", "claim_id"))
    pairs = register.groupingSets([[check, claim], [check, severity, payer]],
                                  check, severity, payer, claim).agg(
        F.expr("grouping(severity) = 1 as of_check"), F.expr("count(*) as found"),
        F.expr(f"{IMPACT} as impact"))
    return grouped(pairs, ["of_check", "check_id", "severity", "payer_id"],
                   "if(of_check, count(claim_id), null) as claims",
                   "if(of_check, null, sum(found)) as found",
                   f"if(of_check, null, cast(sum(impact) as {TOTAL})) as impact")


@dataclass(frozen=True)
class Figures:
    """Written cells of a run. `book`: `book_cells`; `findings`: `finding_cells`."""

    book: DataFrame
    findings: DataFrame

    def control_totals(self) -> DataFrame:
        """The measures of the whole book in one row."""
        counts = [f"{sql_count(f'sum({c})')} as {c}" for c in COUNTS if c != "claim_rows"]
        return aggregate(self.book, *counts,
                         *[f"cast(sum({c}) as {TOTAL}) as {c}" for c in AMOUNTS])

    def claims(self) -> DataFrame:
        """Claims, rows they came in, and two amounts, in one row."""
        return aggregate(
            self.book, f"{sql_count('sum(claims_in_scope)')} as claims",
            f"{sql_count('sum(claim_rows)')} as claim_rows",
            f"cast({sql_zero('sum(billed_total)')} as {TOTAL}) as billed",
            f"cast({sql_zero('sum(variance_adjudicated)')} as {TOTAL}) as net_variance")

    def claims_by(self, key: str) -> DataFrame:
        """`claims` and `billed` per key, an expression over payer_id and verdict."""
        return grouped(self.book, [key], "sum(claims_in_scope) as claims",
                       f"cast(sum(billed_total) as {TOTAL}) as billed")

    def found(self) -> DataFrame:
        """`found`, `critical` and `impact` of the whole register in one row."""
        return aggregate(
            self.findings.filter("not of_check"), f"{sql_count('sum(found)')} as found",
            f"{sql_count(_CRITICAL)} as critical",
            f"cast({sql_zero('sum(impact)')} as {TOTAL}) as impact")

    def found_by(self, key: str) -> DataFrame:
        """`found` and `impact` per key, an expression over check_id, severity and payer_id."""
        return grouped(self.findings.filter("not of_check"), [key], "sum(found) as found",
                       f"cast(sum(impact) as {TOTAL}) as impact")

    def found_by_check(self) -> DataFrame:
        """`found`, `claims` and `impact` per check."""
        return grouped(self.findings, ["check_id"], "sum(found) as found", "sum(claims) as claims",
                       f"cast(sum(impact) as {TOTAL}) as impact")


_CRITICAL = "sum(found) filter (where severity = 'CRITICAL')"


def take_figures(claims: DataFrame, register: DataFrame, path: str) -> Figures:
    """Write the cells of a run to a new folder below `path` and read them back."""
    spark, folder = claims.sparkSession, f"{path}/figures-{uuid.uuid4().hex}"

    def kept(cells: DataFrame, name: str) -> DataFrame:
        # Cells are few: one file, unless payers are many and AQE finds more to be worth it.
        cells.hint("rebalance").write.parquet(f"{folder}/{name}")
        return spark.read.schema(cells.schema).parquet(f"{folder}/{name}")

    return Figures(kept(book_cells(claims), "book"), kept(finding_cells(register), "findings"))
