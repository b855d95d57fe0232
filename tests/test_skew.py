"""Hot keys: a third of all rows under one key gives the same rows, spread over tasks."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F
from rows import PARAMS, claim, feeds, found, layer, remit

from remitwise import fixture
from remitwise.operators import skew
from remitwise.operators.checks import CHECKS, all_exceptions
from remitwise.operators.median import exact_median, exact_quantiles


def hot_feeds():
    """One claim_id, one fingerprint, one orphan, one copied line and NULL ids each hold many."""
    claims = [claim(1, ingest_batch_id=f"B{i % 3}") for i in range(60)]
    claims += [claim(1000 + i, patient_id="HOT") for i in range(60)]
    claims += [claim(2000 + i) for i in range(20)]
    remits = [remit(1, remit_id=f"H{i:03d}") for i in range(60)]
    remits += [remit(3000, remit_id=f"O{i:03d}", check_eft_number=f"E{i}") for i in range(60)]
    remits += [remit(2000) for _ in range(40)]
    remits += [remit(4000, remit_id=f"N{i:03d}", claim_id=None) for i in range(40)]
    remits += [remit(2000 + i) for i in range(1, 20)]
    return claims, remits


def test_small_tasks_change_nothing(spark):
    claims, remits = hot_feeds()
    whole = all_exceptions(layer(spark, claims, remits), PARAMS)
    split = all_exceptions(layer(spark, claims, remits, rows_per_task=7), PARAMS)
    assert whole.exceptAll(split).count() == 0 and split.exceptAll(whole).count() == 0
    counts = Counter(r[0] for r in found(whole, "check_id"))
    assert counts["DQ-01"] == 1
    assert counts["DQ-02"] == 59
    assert counts["DQ-03"] == 59 + 39
    assert counts["DQ-04"] == 60 + 40


def test_large_payer_master_is_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    claims, remits = hot_feeds()
    claims.append(claim(9, payer_id="NEW"))
    claims.append(claim(10, payer_id=""))
    small = layer(spark, claims, remits, rows_per_task=7)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 100)
    large = layer(spark, claims, remits)
    for rows in (small, large):
        assert found(CHECKS["DQ-09"](rows, PARAMS), "entity_key") == [("C10",), ("C9",)]
        assert {r[0] for r in found(CHECKS["DQ-04"](rows, PARAMS), "payer_name")} == {
            "Medicare Part B"}
    assert small.grain.exceptAll(large.grain).count() == 0


def test_hot_key_reaches_several_partitions(spark):
    rows = spark.range(1000).selectExpr("id", "cast(if(id % 3 = 0, 0, id) as string) as k")
    facts = rows.groupBy("k").agg(F.expr("count(*) as n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.spread_join(rows, facts, ["k"], "n", "id", rows_per_task=20)
        places = joined.filter("k = '0'").select(F.spark_partition_id()).distinct().count()
        assert joined.count() == 1000 and joined.filter("n = 334").count() == 334
        assert places > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_and_null_dimension_keys_are_split_too(spark):
    rows = spark.range(900).selectExpr("id", "element_at(array('x', null, 'a'), int(id % 3) + 1) as k")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.lookup(rows, dim, "k", "id", broadcast=False, rows_per_task=20)
        assert joined.columns == ["id", "k", "name"]
        assert joined.count() == 900 and joined.filter("name = 'A'").count() == 300
        for key in ("k = 'x'", "k is null", "k = 'a'"):
            places = joined.filter(key).select(F.spark_partition_id()).distinct().count()
            assert places > 4, key
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_match(spark):
    rows = spark.createDataFrame([(i, None if i < 5 else "a") for i in range(9)], "id int, k string")
    facts = rows.groupBy("k").agg(F.expr("count(*) as n"))
    assert skew.spread_join(rows, facts, ["k"], "n", "id", 2, null_keys=True).count() == 9
    assert skew.spread_join(rows, facts, ["k"], "n", "id", 2).count() == 4


def test_repeats_against_sorting(spark):
    data = [(i, f"k{i * i % 7}" if i % 5 else None, (i * 37) % 11 if i % 4 else None)
            for i in range(200)]
    df = spark.createDataFrame(data, "id int, k string, v int")
    groups = {}
    for row in sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
        groups.setdefault(row[1], []).append(row)
    want = sorted((r[0], rows[0][0]) for rows in groups.values() for r in rows[1:])
    got = skew.repeats(df, ["k"], ["v", "id"], "id", "id", rows_per_task=9, null_keys=True)
    assert sorted((r.id, r.original_id) for r in got.collect()) == want


def test_median_against_sorting(spark):
    for n, step in ((1, 1), (2, 7), (7, 13), (100, 997), (101, 12345)):
        cents = [(i * step * 31) % 1_000_003 for i in range(n)]
        df = spark.createDataFrame([(c,) for c in cents], "c long").selectExpr(
            "cast(c / 100 as decimal(18,2)) as m")
        cents.sort()
        want = (cents[(n - 1) // 2] + cents[n // 2]) / 200
        assert float(exact_median(df, "m", "x").first().x) == want
    # A million amounts that share four digits, so that no bucket of leading digits is small.
    crowd = spark.range(1_000_000).selectExpr("cast((12340000 + id % 9973) / 100 as decimal(18,2)) as m")
    row = exact_quantiles(crowd, "m", "x", q90=90, q99=99).first()
    order = sorted(12340000 + i % 9973 for i in range(1_000_000))
    assert [int(v * 1000) for v in row] == [5 * (order[499_999] + order[500_000]),
                                            10 * order[899_999], 10 * order[989_999]]
    empty = spark.range(0).selectExpr("cast(id as decimal(18,2)) as m")
    assert tuple(exact_quantiles(empty, "m", "x", q90=90).first()) == (None, None)
    assert exact_median(empty, "m", "x").first().x is None


def test_first_row_of_a_hot_claim_is_combined_before_the_exchange(spark):
    claims, _ = feeds(spark, hot_feeds()[0], [])
    from remitwise.operators.layers import claims_by_id, typed_claims
    plan = claims_by_id(typed_claims(claims))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange hashpartitioning") == 1


def test_only_repeated_ids_are_aggregated(spark):
    """Rows of an id that comes once go to the join as they are, with the outcome of the aggregation."""
    from remitwise.operators.layers import (alone_and_repeated, landed_grain, typed_claims,
                                            typed_grain, typed_remits)
    ids = ["C1", " C1 ", "C2", None, None, "", "  ", *[f"C{n}" for n in range(3, 400)]]
    claims, remits = feeds(
        spark, [claim(n, claim_id=i, source_system=f"S{n}") for n, i in enumerate(ids)],
        [remit(n, claim_id=i) for n, i in enumerate(["C1", "C2", "C2", "X", None, None, *ids[20:]])])
    alone, repeated = alone_and_repeated(claims, "trim(claim_id)")
    rest = {row.claim_id for row in repeated.collect()}
    assert rest >= {"C1", " C1 ", None, "", "  "} and len(rest) < 40
    assert alone.count() + repeated.count() == len(ids)
    lines = typed_remits(remits)
    payers = fixture.payers(spark)
    want = typed_grain(typed_claims(claims), lines, payers, True)
    got = landed_grain(claims, lines, payers, True)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert found(got) == found(want)


def test_large_tables_are_dealt_evenly(spark, tmp_path):
    """Splits of as many files as there are cores, one of which holds nearly all rows."""
    for part in range(8):
        rows = 8000 if part == 0 else 1
        spark.range(part * 10_000, part * 10_000 + rows).selectExpr(
            "id as o_orderkey", "timestamp'2001-01-01' as o_orderdate").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "orders.parquet"))
    held = fixture.claims(spark, str(tmp_path), False).groupBy(
        F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in held) < 2 * 8007 / 8


def test_a_claim_alone_in_both_feeds_is_joined_as_it_is(spark):
    """Only ids that a feed repeats are aggregated; feeds in buckets need no exchange for it either."""
    from remitwise.operators.layers import landed_grain, typed_remits
    claims, remits = feeds(spark, [claim(n) for n in range(200)] + [claim(3), claim(4)],
                           [remit(n) for n in range(5, 200)] + [remit(7), remit(500)])
    grain = landed_grain(claims, typed_remits(remits), fixture.payers(spark), True)
    joined = grain._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("Join FullOuter") == 2
    # Amounts of the lines that are alone reach the join as narrow as they came.
    alone = joined[:joined.index("Aggregate")]
    assert "Join FullOuter" in alone and "sum(" not in alone
    rows = {r.claim_id: r for r in grain.collect()}
    assert len(rows) == 201
    assert [rows[i].occurrences for i in ("C3", "C4", "C5")] == [2, 2, 1]
    assert [rows[i].remit_line_count for i in ("C3", "C7", "C500")] == [0, 2, 1]
    assert not rows["C500"].in_claims and rows["C7"].paid_total == 2 * rows["C8"].paid_total


def test_buckets_are_reconciled_without_an_exchange(spark, tmp_path):
    from remitwise.operators.layers import bucketed_grain, typed_claims, typed_grain, typed_remits
    from remitwise.sources import layout
    raw = feeds(spark, [claim(n) for n in range(300)] + [claim(3)],
                [remit(n) for n in range(5, 300)] + [remit(7), remit(500)])
    laid = layout.lay_out(*raw, str(tmp_path), 4)
    grain = bucketed_grain(laid.claims, laid.remits, fixture.payers(spark), True)
    want = typed_grain(typed_claims(raw[0]), typed_remits(raw[1]), fixture.payers(spark), True)
    assert grain.schema.simpleString() == want.schema.simpleString()
    assert found(grain) == found(want)
    plan = grain._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(claim_id" not in plan


def test_the_claim_checks_are_compiled(spark):
    """The JVM never compiles a method above 8,000 bytes."""
    import re

    from remitwise.operators.checks import all_exceptions_fused
    from remitwise.operators.layers import build_layer
    claims, remits = feeds(spark, [claim(n, cpt_code="x", units="") for n in range(50)],
                           [remit(n) for n in range(5, 50)])
    layer = build_layer(spark, claims, remits, fixture.payers(spark))
    fused = all_exceptions_fused(layer, PARAMS)
    assert found(fused) == found(all_exceptions(layer, PARAMS))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fused.select("*")._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan.explainString(mode))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(map(int, sizes)) < 8000
