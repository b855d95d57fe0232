"""Working the register: verdicts, triage, service levels, escalation, dispositions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitwise.functions.scalars import (sql_add_business_days, sql_money, sql_rate, sql_zero)
from remitwise.operators.bloom import may_match
from remitwise.operators.median import exact_quantiles
from remitwise.plans.reports import IMPACT, PAYER, aggregate, grouped, sql_count
from remitwise.schemas import SEVERITY_RANK, SLA_DAYS, TOTAL

# The thresholds at which a defect leaves its queue.
SINGLE_VARIANCE_LIMIT = 500
MISSING_REMIT_LIMITS = (10, 5000)
UNDERPAID_LIMITS = (25, 5000)
RUN_RATE_LIMIT_PCT = Decimal("0.5")
REPEATED_RUNS = 3
UNMATCHED_DAYS = 2
REPEATED_FEED_RUNS = 2
CLOSED = ["RESOLVED", "WAIVED", "CARRIED FORWARD"]


def _map_lookup(values: dict, key: str) -> str:
    pairs = ", ".join(f"'{k}', {v}" for k, v in values.items())
    return f"try_element_at(map({pairs}), {key})"


def run_verdict(summary: DataFrame, claim_unique: DataFrame,
                rate_limit_pct: Decimal = RUN_RATE_LIMIT_PCT) -> DataFrame:
    """PASS when no CRITICAL check has findings and the total rate is below the limit."""
    critical = "sum(exceptions_found) filter (where severity = 'CRITICAL')"
    found = aggregate(summary, f"{sql_count('sum(exceptions_found)')} as exceptions",
                      f"{sql_count(critical)} as critical_exceptions")
    claims = aggregate(claim_unique, "count(*) as claims")
    below = (f"100 * cast(exceptions as decimal(18,0)) "
             f"< {rate_limit_pct:f} * cast(claims as decimal(18,0))")
    return found.crossJoin(claims).selectExpr(
        "claims", "exceptions", "critical_exceptions",
        f"{sql_rate('exceptions', 'claims', 100, 3)} as exception_rate_pct",
        f"if(critical_exceptions = 0 and (exceptions = 0 or {below}), 'PASS', 'FAIL') as verdict")


def suite_verdict(validation: DataFrame, control: DataFrame) -> DataFrame:
    """PASS when every planted defect is found, nothing else is, and clean data gives nothing."""
    scored = aggregate(validation, "sum(injected_defects) as injected",
                       "sum(false_negatives) as false_negatives",
                       "sum(false_positives) as false_positives")
    clean = aggregate(control, "sum(false_positives) as clean_findings")
    return scored.crossJoin(clean).selectExpr(
        "*", "if(false_negatives = 0 and false_positives = 0 and clean_findings = 0, "
             "'PASS', 'FAIL') as verdict")


def class_rollup(register: DataFrame, routing: DataFrame) -> DataFrame:
    """Volume and exposure per finding class, and a TOTAL row."""
    found = grouped(register, ["check_id"], "count(*) as found", f"{IMPACT} as exposure")
    rows = routing.join(F.broadcast(found), "check_id", "left").rollup("finding_class").agg(
        F.expr("array_join(array_sort(collect_set(check_id)), ', ') as checks"),
        F.expr(f"{sql_count('sum(found)')} as volume"),
        F.expr(f"cast({sql_zero('sum(exposure)')} as {TOTAL}) as exposure_usd"),
        F.expr("grouping(finding_class) as is_total"))
    return rows.selectExpr("if(is_total = 1, 'TOTAL', finding_class) as finding_class",
                           "if(is_total = 1, null, checks) as checks", "volume", "exposure_usd")


# Parts of a queue that are ranked apart before they meet.
TRIAGE_PARTS = 64


def triage_order() -> list:
    """Severity first, then exposure descending; the rest makes the order total."""
    return [F.expr(_map_lookup(SEVERITY_RANK, "severity")).asc_nulls_last(),
            F.expr("abs(amount_impact)").desc_nulls_last(), F.col("check_id").asc_nulls_last(),
            F.col("entity_key").asc_nulls_last(), F.col("finding").asc_nulls_last()]


def triage_queue(register: DataFrame, n: int) -> DataFrame:
    """The first `n` open items of every queue, ranked.

    A queue is cut into `TRIAGE_PARTS` by a hash of the item; each part keeps its first `n` and only
    those meet, so a long queue does not reach one task, whatever `n` is.
    """
    by_queue = Window.partitionBy("assigned_queue").orderBy(*triage_order())
    by_part = Window.partitionBy("assigned_queue", "part").orderBy(*triage_order())
    return (register.filter("disposition = 'OPEN'")
            .select("assigned_queue", "severity", "check_id", "entity_key", "claim_id",
                    "amount_impact", "finding")
            .withColumn("part", F.expr(f"pmod(xxhash64(entity_key, finding), {TRIAGE_PARTS})"))
            .withColumn("part_rank", F.row_number().over(by_part))
            .filter(F.col("part_rank") <= n).drop("part", "part_rank")
            .withColumn("queue_rank", F.row_number().over(by_queue))
            .filter(F.col("queue_rank") <= n)
            .withColumn("queue_rank", F.col("queue_rank").cast("long")))


def worklist(register: DataFrame) -> DataFrame:
    """All open items in working order, queue after queue."""
    return register.filter("disposition = 'OPEN'").orderBy(
        F.col("assigned_queue").asc_nulls_last(), *triage_order())


def with_sla(register: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The register with `due_ts` and `sla_status`."""
    days = _map_lookup(SLA_DAYS, "check_id")
    # An item due in business days may be closed until its last day ends.
    day_end = f"cast(date_add({sql_add_business_days('to_date(run_ts)', days)}, 1) as timestamp)"
    late = f"timestamp'{as_of.isoformat(' ')}' > due_ts"
    return register.selectExpr(
        "*", f"if({days} = 0, run_ts + interval 24 hours, {day_end}) as due_ts").selectExpr(
        "*", "case when due_ts is null then 'NO SLA' when disposition <> 'OPEN' then 'CLOSED' "
             f"when {late} then 'BREACHED' else 'IN TIME' end as sla_status")


def sla_ageing(register: DataFrame, as_of: dt.datetime) -> DataFrame:
    """When each item is due, and whether an open item is past that."""
    return with_sla(register, as_of).select(
        "check_id", "severity", "entity_key", "assigned_queue", "disposition", "run_ts", "due_ts",
        "sla_status", "finding")


def escalations(register: DataFrame) -> DataFrame:
    """Items and groups that crossed an escalation threshold of one run.

    What takes time or several runs to escalate is in `unmatched_payments` and `repeating_feeds`.
    """
    single = (register
              .filter(f"check_id = 'DQ-06' and abs(amount_impact) > {SINGLE_VARIANCE_LIMIT}")
              .selectExpr("check_id", "'claim' as scope", "entity_key as scope_key",
                          "1L as items", f"cast(abs(amount_impact) as {TOTAL}) as exposure_usd",
                          "'Payer Relations' as escalate_to"))

    def by_group(check_id: str, scope: str, key: str, limits: tuple[int, int],
                 escalate_to: str) -> DataFrame:
        count, exposure = limits
        return (grouped(register.filter(f"check_id = '{check_id}'"), [f"{key} as scope_key"],
                        "count(*) as items", f"{sql_zero(IMPACT)} as exposure_usd")
                .filter(f"items >= {count} or exposure_usd >= {exposure}")
                .selectExpr(f"'{check_id}' as check_id", f"'{scope}' as scope", "scope_key",
                            "items", "exposure_usd", f"'{escalate_to}' as escalate_to"))

    return (single
            .unionByName(by_group("DQ-05", "run", "run_id", MISSING_REMIT_LIMITS, "A/R manager"))
            .unionByName(by_group("DQ-08", "payer", PAYER, UNDERPAID_LIMITS, "Payer Relations")))


def unmatched_payments(register: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Payments without a claim (DQ-04) that are open when their business days have ended."""
    ended = (f"cast(date_add({sql_add_business_days('to_date(run_ts)', str(UNMATCHED_DAYS))}, 1) "
             "as timestamp)")
    late = register.filter("check_id = 'DQ-04' and disposition = 'OPEN'").filter(
        f"timestamp'{as_of.isoformat(' ')}' > {ended}")
    return grouped(late, ["check_id", "run_id", "entity_key"], "count(*) as items",
                   f"{sql_zero(IMPACT)} as exposure_usd").selectExpr(
        "check_id", "run_id", "'payment' as scope", "entity_key as scope_key", "items",
        "exposure_usd", "'Payer' as escalate_to")


def repeating_feeds(register: DataFrame, claims: DataFrame, runs: DataFrame,
                    min_runs: int = REPEATED_FEED_RUNS) -> DataFrame:
    """Source systems with temporal breaks (DQ-11) in `min_runs` consecutive runs or more.

    `claims` has one row per claim_id; only those that may have a break are shuffled to the join.
    """
    broken = register.filter("check_id = 'DQ-11'").select("run_id", "check_id", "claim_id")
    sources = may_match(claims.selectExpr(
        "claim_id", "coalesce(source_system, 'UNKNOWN') as scope_key"), broken, ["claim_id"])
    return repeat_defects(broken.join(sources, "claim_id"), runs, ["check_id", "scope_key"],
                          min_runs).selectExpr(
        "check_id", "'feed' as scope", "scope_key", "first_run", "last_run", "consecutive_runs",
        "exceptions as items", "'Interface team' as escalate_to")


def repeat_defects(register: DataFrame, runs: DataFrame, keys: list[str] | None = None,
                   min_runs: int = REPEATED_RUNS) -> DataFrame:
    """Defects found in at least `min_runs` consecutive runs.

    `runs` (run_id, run_ts) lists every run, also those without findings. `keys` names what makes
    a defect, by default the check.
    """
    keys = keys or ["check_id"]
    # The run log has one row per run, so ranking it in one task is safe.
    numbered = runs.select("run_id", "run_ts").distinct().withColumn(
        "run_no", F.row_number().over(Window.orderBy("run_ts", "run_id")))
    seen = grouped(register, [*keys, "run_id"], "count(*) as found")
    in_order = Window.partitionBy(*keys).orderBy("run_no")
    island = F.col("run_no") - F.row_number().over(in_order)
    return (grouped(seen.join(numbered, "run_id").withColumn("island", island),
                    [*keys, "island"], "count(*) as consecutive_runs",
                    "min_by(run_id, run_no) as first_run", "max_by(run_id, run_no) as last_run",
                    "sum(found) as exceptions")
            .filter(f"consecutive_runs >= {min_runs}")
            .drop("island"))


def disposition_violations(register: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Items that break the closing rules."""
    closed = "disposition in (" + ", ".join(f"'{c}'" for c in CLOSED) + ")"
    violation = f"""case
        when disposition is null then 'no disposition'
        when disposition <> 'OPEN' and not {closed} then 'unknown disposition'
        when {closed} and coalesce(trim(disposition_reason), '') = ''
            then 'closed without a reason'
        when disposition = 'RESOLVED' and resolved_ts is null then 'resolved without a time'
        when sla_status = 'BREACHED' then 'open past its SLA' end as violation"""
    return (with_sla(register, as_of).selectExpr("*", violation).filter("violation is not null")
            .select("run_id", "check_id", "entity_key", "assigned_queue", "disposition",
                    "disposition_reason", "violation", "finding"))


def variance_profile(recon: DataFrame, register: DataFrame, check_id: str = "DQ-06") -> DataFrame:
    """Net and absolute variance of adjudicated claims; median, 90 % and 99 % quantile and largest item
    of a check."""
    book = aggregate(
        recon.filter("remit_line_count > 0"),
        f"cast({sql_zero('sum(balance_variance)')} as {TOTAL}) as net_variance",
        f"cast({sql_zero('sum(abs(balance_variance))')} as {TOTAL}) as absolute_variance")
    items = register.filter(F.col("check_id") == check_id)
    sized = aggregate(items, "count(*) as items",
                      f"cast(max(abs(amount_impact)) as {TOTAL}) as largest_item")
    ranked = exact_quantiles(items, "abs(amount_impact)", "median_item", q90_item=90, q99_item=99)
    return book.crossJoin(sized).crossJoin(ranked).selectExpr(
        "net_variance", "absolute_variance", "items", "largest_item",
        f"{sql_money('median_item')} as median_item", "q90_item", "q99_item")


def entry_criteria(receipt: DataFrame, received: dict[str, int] | None = None) -> DataFrame:
    """Whether every table arrived with rows, none set aside, and with the count announced for it.

    `received` holds the announced counts; a table it names that the receipt lacks is ABSENT.
    """
    spark, received = receipt.sparkSession, received or {}
    announced = spark.createDataFrame(list(received.items()),
                                      "table_name string, rows_received bigint")
    return receipt.join(F.broadcast(announced), "table_name", "full").selectExpr(
        "table_name", "rows_loaded", "rows_received", "rows_rejected",
        "case when rows_loaded is null then 'ABSENT' when rows_loaded = 0 then 'EMPTY' "
        "when rows_rejected > 0 then 'REJECTS' when rows_loaded < rows_received then 'SHORT' "
        "when rows_loaded > rows_received then 'SURPLUS' else 'MET' end as criterion")
